"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck
from watchtally.plans.catalog import registry

# queries of the subpackage that may be absent are tested beside it
OWN = set(registry())
NAMES = sorted(OWN)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert OWN <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["userCode", "taskCode", "eventType", "videoId"]
    assert df.count() > 0

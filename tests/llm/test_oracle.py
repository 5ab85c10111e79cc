"""Queries whose results SQL expresses, side by side with DuckDB."""

import pytest

from tests.conftest import SF_MID
from tools.check_oracle import compare, duck
from watchtally.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SF_MID), duck(SF_MID), ORACLE_SQL[name])
    assert ok, message

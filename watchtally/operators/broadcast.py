"""Broadcast a join side only behind a checked size bound."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side takes memory of the driver and of every executor.
DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 128 << 20
#: A measured size is believed for so long: every query or micro-batch that joins the
#: same side in the meantime is planned without measuring it again.
BELIEVED_SECONDS = 60.0
_measured: dict[int, tuple[float, int, int]] = {}


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a side: one pass over its columns, each task sends two numbers.

    Bytes are those of the values plus the 8-byte words of a row in memory."""
    key, now = df.semanticHash(), time.monotonic()
    known = _measured.get(key)
    if known is None or now - known[0] >= BELIEVED_SECONDS:
        for old in [k for k, v in _measured.items() if now - v[0] >= BELIEVED_SECONDS]:
            del _measured[old]
        size = F.lit(8 * (1 + len(df.columns))).cast("bigint")
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StringType | T.BinaryType):
                size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
            elif not isinstance(f.dataType, T.NumericType | T.BooleanType | T.DateType | T.TimestampType):
                size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        rows, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
        known = _measured[key] = (now, int(rows), int(total or 0))
    return known[1:]


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      max_bytes: int = DEFAULT_MAX_BYTES, source: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` if it is within both bounds, else a sort-merge join.

    ``source`` is what the side is reduced from (it has at least its rows and columns): it
    is measured instead, so that the reduction and its shuffle run once, in the join.
    Above a bound the side carries a ``merge`` hint, so Spark never broadcasts it from an
    estimate (file sizes understate in-memory size); the shuffle join then gets AQE's
    skew-partition splitting.
    """
    rows, size = measure(df if source is None else source)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df.hint("merge")

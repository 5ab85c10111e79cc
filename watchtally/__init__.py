"""watchtally: sessionized watch-progress and rule-completion analytics on Spark.

Every stage is a ``DataFrame -> DataFrame`` function built from Spark's own
operators (JSON/variant functions, joins, aggregates, window functions,
session windows, keyed state), so batch and Structured Streaming share one
code path wherever Spark allows it.
"""

from watchtally.session import build_spark, shared_dir

__all__ = ["build_spark", "shared_dir"]

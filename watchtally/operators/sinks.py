"""JSON encodings and sink writers.

Connectors come from options (``format`` + ``options``); nothing about an
endpoint is hard-coded. Kafka and JDBC need their connector jars on the
cluster classpath; tests use file and memory sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtally.functions.scalar import VIDEO


def to_json_value(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One JSON object per row in a ``value`` column (nulls omitted)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def result_json(completed: DataFrame) -> DataFrame:
    """``{"userCode","taskCode","eventType":"video","videoId"}`` in that order."""
    return completed.select(F.to_json(F.struct(
        "userCode", "taskCode", F.lit(VIDEO).alias("eventType"), "videoId")).alias("value"))


def upsert_latest(df: DataFrame, key_cols: list[str], order_col: str) -> DataFrame:
    """Latest row per key as (key JSON, value JSON).

    One ``max_by`` per column is an ordinary aggregate with map-side partial
    aggregation, so a hot key is reduced before the shuffle. ``order_col`` must be
    unique within a key (a session's start is).
    """
    rest = [c for c in df.columns if c not in key_cols]
    g = df.groupBy(*key_cols).agg(*[F.max_by(c, order_col).alias(c) for c in rest])
    return g.select(F.to_json(F.struct(*key_cols)).alias("key"),
                    F.to_json(F.struct(*df.columns)).alias("value"))


def upsert_stream(df: DataFrame, key_cols: list[str], order_col: str, checkpoint: str, write,
                  trigger: dict | None = None, query_name: str | None = None):
    """S6 for streams: publish (key JSON, value JSON) through ``write(df, epoch_id)``, in order.

    The latest row of every key is the state of the aggregation, so it spans micro-batches:
    a key that gets an older row later is published again with the newest one, and
    an upsert sink (compacted topic, MERGE target), which keeps the last value
    of a key, is left unchanged by it. A retried micro-batch publishes the same rows.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        write(batch, epoch_id)
    w = (upsert_latest(df, key_cols, order_col).writeStream.foreachBatch(run)
         .outputMode("update").option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return (w.queryName(query_name) if query_name else w).start()


def write_batch(df: DataFrame, fmt: str, path: str | None = None,
                options: dict | None = None, mode: str = "append") -> None:
    """S5/S7/S10 batch writer: ``kafka``, ``json``, ``text``, ``parquet`` ..."""
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    w.save(path) if path else w.save()


def write_stream(df: DataFrame, fmt: str, checkpoint: str, path: str | None = None,
                 options: dict | None = None, output_mode: str = "append",
                 trigger: dict | None = None, query_name: str | None = None):
    """S5/S7/S8 streaming writer (``kafka``, ``console``, ``memory``, files)."""
    w = (df.writeStream.format(fmt).outputMode(output_mode)
           .option("checkpointLocation", checkpoint).options(**(options or {})))
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start(path) if path else w.start()


def replay_lines(spark, src_path: str, fmt: str, dst_path: str | None = None,
                 options: dict | None = None) -> None:
    """Line-JSON file -> topic (or any sink), as one Spark job."""
    write_batch(spark.read.text(src_path), fmt, dst_path, options)

"""Run streaming queries to completion and hand back their output.

Everything lives in a fresh folder under the cluster's shared checkpoint root
(``spark.checkpoint.dir``): input files for replays, the sink's files and the
query checkpoint, so a restarted query resumes from its offsets and state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtally.session import shared_dir


def write_json_lines(df: DataFrame, path: str, order_col: str | None = None) -> None:
    """Write rows as JSON lines (a topic replay file set), ``order_col``-sorted per file."""
    out = df.sortWithinPartitions(order_col) if order_col else df
    out.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_time_slices(df: DataFrame, path: str, slices: int, order_col: str = "ts") -> int:
    """Write a replay topic in event-time order and return how many files are a slice.

    Rows are dealt by ranges of time to ``slices`` times as many files as a query has state
    partitions (cores in local mode, else the session's shuffle partitions), in one job. No file holds a time before that of an earlier file,
    and files are stamped in that order, which is the order in which a file
    stream takes them: with ``maxFilesPerTrigger`` of one slice, a micro-batch is read
    by as many tasks as a shuffle has, whatever the size of the topic.
    """
    spark = df.sparkSession
    per_slice = state_partitions(spark) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.coalesce(F.col(order_col), F.lit(0).cast("bigint"))
    kept = df.persist()                                  # ranges are sampled before the write
    try:
        write_json_lines(kept.repartitionByRange(slices * per_slice, at), path, order_col)
    finally:
        kept.unpersist()
    _stamp_in_order(spark, path)
    return per_slice


def _stamp_in_order(spark: SparkSession, path: str) -> None:
    """Give the part files of a folder rising modification times, a second apart."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = {int(f.getPath().getName().split("-")[1]): f for f in fs.listStatus(folder)
             if f.getPath().getName().startswith("part-")}
    latest = max((f.getModificationTime() for f in parts.values()), default=0)
    for back, number in enumerate(sorted(parts, reverse=True)):
        fs.setTimes(parts[number].getPath(), latest - 1000 * back, -1)


def state_partitions(spark: SparkSession) -> int | None:
    """State-store partitions for a new query: the core count in local mode,
    otherwise whatever the cluster configured (None = keep the session's)."""
    try:
        sc = spark.sparkContext
    except Exception:  # no driver-side context (e.g. a Spark Connect session)
        return None
    return sc.defaultParallelism if sc.master.startswith("local") else None


def run_available_now(df: DataFrame, name: str, spark: SparkSession,
                      fmt: str = "parquet", timeout_s: float | None = None,
                      partitions: int | None = None, base: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over all available input, return its output.

    ``partitions`` fixes the query's shuffle/state partitions; a streaming
    query copies the session settings when it starts and keeps the count in
    its checkpoint, so the session's own value is restored right after.
    Passing the same ``base`` again resumes the query from its checkpoint.
    There is no time limit unless ``timeout_s`` is given.
    """
    base = base or shared_dir(spark, name)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if partitions:
        spark.conf.set(key, str(partitions))
    try:
        q = (df.writeStream.format(fmt).outputMode("append")
               .option("checkpointLocation", f"{base}/checkpoint")
               .option("path", f"{base}/out")
               .trigger(availableNow=True)
               .queryName(f"{name}_{base.rsplit('-', 1)[-1][:8]}")
               .start())
    finally:
        spark.conf.set(key, before)
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        if finished is False:
            raise TimeoutError(f"streaming query {name} did not finish in {timeout_s}s")
        if q.exception():
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def stream_stats(q) -> dict:
    """Totals over a finished query's progress reports (rows in, late drops)."""
    rows_in = 0
    dropped = 0
    for p in q.recentProgress:
        rows_in += p.numInputRows or 0
        for s in p.stateOperators or []:
            dropped += s.numRowsDroppedByWatermark or 0
    return {"numInputRows": rows_in, "numRowsDroppedByWatermark": dropped}

"""S9, S11 (streaming): topic tail and the keyed-state snapshot of job 2."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchtally.streaming.completion import STATE_NAME, TASK_SCHEMA


def completion_state_snapshot(spark: SparkSession, checkpoint: str,
                              operator_id: int | None = None) -> DataFrame:
    """Every (user, video, task) state of a job-2 query, read from its checkpoint
    (one row a task of each key) — the stream's counterpart of the reference's
    key listing. Finds the keyed-state operator when ``operator_id`` is not given."""
    if operator_id is None:
        meta = spark.read.format("state-metadata").load(checkpoint)
        own = [r.operatorId for r in meta.select("operatorId", "operatorName").distinct().collect()
               if r.operatorName.startswith("transformWithState")]
        if len(own) != 1:
            raise ValueError(f"{len(own)} keyed-state operators in {checkpoint}")
        operator_id = own[0]
    df = (spark.read.format("statestore").option("operatorId", operator_id)
          .option("stateVarName", STATE_NAME).load(checkpoint))
    state = "value" if "tasks" in df.schema["value"].dataType.names else "value.value"   # with a time to live
    tasks = F.from_json(f"{state}.tasks", T.ArrayType(TASK_SCHEMA), {"mode": "FAILFAST"})
    return (df.select("key.watch.*", F.inline(tasks))
              .select("userCode", "videoId", *[c for c in TASK_SCHEMA.names if c != "changed"]))


def _print_row(label: str, row) -> None:
    print(f"[{label}] {row[0]}" if label else row[0], flush=True)


def print_rows(df: DataFrame, label: str = "") -> None:
    """Print every row of a batch, whole, on the executors that hold it."""
    df.select(F.to_json(F.struct(*df.columns))).foreach(partial(_print_row, label))


def print_stream(df: DataFrame, checkpoint: str, label: str = "", trigger: dict | None = None):
    """Print every row of a stream, whole, on the executors that hold it
    (a single ``value`` column as it is, other rows as JSON)."""
    text = df if df.columns == ["value"] else df.select(F.to_json(F.struct(*df.columns)))
    w = (text.writeStream.foreach(partial(_print_row, label))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.queryName(label).start() if label else w.start()


def tail_topic(spark: SparkSession, fmt: str, options: dict, checkpoint: str,
               sink: str = "print", query_name: str | None = None,
               trigger: dict | None = None, path: str | None = None):
    """Print every line of a topic as it arrives, whole, or hand it to another sink."""
    from watchtally.sources.logs import read_lines
    lines = read_lines(spark, fmt, options=options, stream=True)
    if sink == "print":
        return print_stream(lines, checkpoint, query_name or "", trigger)
    w = lines.writeStream.format(sink).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if path:
        w = w.option("path", path)
    if query_name:
        w = w.queryName(query_name)
    return w.start()

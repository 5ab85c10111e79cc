"""T7 streaming form: keyed state of one (user, video), emit each completion once.

Runs right after the session-window aggregation and the broadcast rule join, in one
streaming query or behind a topic of matched sessions. A key's input is the few
sessions that closed in a micro-batch, each with the tasks of its level; its state
(RocksDB, checkpointed with the source offsets: SURVEY Q11) is one value:

* ``tasks``: for each task code the running totals, first thresholds and flag;
* ``last``: the start of the last session that was counted. A user's sessions of a
  video close in order, so a session that doesn't lie behind it was counted before: a
  topic that delivers a session again after a failure changes nothing.

One call, one state read and one write for each (user, video), however many tasks it
has: every access of the state is a round trip between the Python worker and the JVM.

The grouping column is one struct, ``watch``: keyed state on the same two columns
that a session window above it is keyed on doesn't start in this Spark version.
"""

from __future__ import annotations

import json
from typing import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from watchtally.functions.scalar import VIDEO

TASK_SCHEMA = T.StructType([
    T.StructField("taskCode", T.StringType()),
    T.StructField("complete", T.BooleanType()),
    T.StructField("videoLength", T.LongType()),
    T.StructField("videoPercent", T.DoubleType()),
    T.StructField("ruleLength", T.IntegerType()),
    T.StructField("rulePercent", T.DoubleType()),
    T.StructField("changed", T.LongType()),     # wall clock, with a time to live only
])
# the tasks as JSON records: Spark takes about a millisecond to write a nested value of Python's
STATE_SCHEMA = T.StructType([
    T.StructField("last", T.LongType()),
    T.StructField("tasks", T.StringType()),
])

OUTPUT_SCHEMA = T.StructType([
    T.StructField("userCode", T.StringType()),
    T.StructField("taskCode", T.StringType()),
    T.StructField("eventType", T.StringType()),
    T.StructField("videoId", T.StringType()),
    T.StructField("s0", T.LongType()),
])

STATE_NAME = "tasks"
TASK_FIELDS = TASK_SCHEMA.names


def advance(state: tuple | None, length: int, percent: float, rule_length: int,
            rule_percent: float) -> tuple:
    """One task's state after one more session (T7a first insert, T7b update).

    Totals grow by the session; thresholds stay those of the first one (A6)."""
    if state is not None:
        _, total, ratio, rule_length, rule_percent = state
        length, percent = total + length, ratio + percent
    done = length >= rule_length and percent >= rule_percent
    return (done, length, percent, rule_length, rule_percent)


class CompletionProcessor(StatefulProcessor):
    """The emit-once completion machine (T7a first insert, T7b update, T7c frozen)."""

    def __init__(self, state_ttl_ms: int | None = None):
        self.state_ttl_ms = state_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # optional expiry of idle keys
        self.state = handle.getValueState(STATE_NAME, STATE_SCHEMA, self.state_ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.state.get()
        last = None if old is None else old[0]
        sessions = sorted((r for r in rows if last is None or r["s0"] > last),
                          key=lambda r: r["s0"])
        if not sessions:
            return
        ttl = self.state_ttl_ms
        now = timerValues.getCurrentProcessingTimeInMs() if ttl else None
        known = {} if old is None else {t["taskCode"]: tuple(t.values())[1:] for t in json.loads(old[1])
                                        if not ttl or t["changed"] + ttl > now}
        for r in sessions:
            for t in r["tasks"]:
                code = t["taskCode"]
                before = known.get(code)
                if before is not None and before[0]:
                    continue                                 # T7c: frozen
                new = advance(before and before[:5], int(r["measure"]), float(r["videoPercent"]),
                              int(t["ruleLength"]), float(t["rulePercent"]))
                known[code] = (*new, now)
                if new[0]:
                    yield Row(userCode=key[0]["userCode"], taskCode=code, eventType=VIDEO,
                              videoId=key[0]["videoId"], s0=int(r["s0"]))
        tasks = [dict(zip(TASK_FIELDS, (code, *t))) for code, t in known.items()]
        self.state.update((int(sessions[-1]["s0"]), json.dumps(tasks)))

    def close(self) -> None:
        pass


def apply_completion(matched: DataFrame, measure_col: str = "videoLength",
                     state_ttl_ms: int | None = None) -> DataFrame:
    """Keyed-state completion of a stream of sessions with their ``tasks``
    (:func:`watchtally.operators.rules.match_tasks`).

    ``state_ttl_ms`` lets a key's state expire after that long without updates
    (processing time); by default state is kept forever like the reference."""
    usable = F.filter("tasks", lambda t: t["ruleLength"].isNotNull() & t["rulePercent"].isNotNull())
    rows = matched.select(                                   # Q10: JVM-side filter
        F.struct("userCode", "videoId").alias("watch"), "s0",
        F.col(measure_col).cast("bigint").alias("measure"), "videoPercent", usable.alias("tasks"))
    return (rows.where(F.size("tasks") > 0).groupBy("watch")
                .transformWithState(
                    statefulProcessor=CompletionProcessor(state_ttl_ms),
                    outputStructType=OUTPUT_SCHEMA,
                    outputMode="Append",
                    timeMode="ProcessingTime" if state_ttl_ms else "None"))

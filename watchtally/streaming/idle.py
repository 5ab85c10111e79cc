"""Sessions that close on the watermark or after a wall-clock idle delay.

The reference's (unwired) trigger fires a session window either when the
event-time watermark passes its end or ``delay`` after it in processing
time, whichever comes first, so a user who stops sending events still gets a result.
Spark's session windows only close on the watermark, so this is a keyed processor
with one processing-time timer per key, which reads the query's watermark too. Sessions
are those of a (user, video). Every call and every access of its state or timers is a
round trip between the Python worker and the JVM, so a key is a user with a
watermark: one state value holds the user's videos, and those whose late rows the watermark
drops by itself (two gaps behind it) leave it, so it stays as small as what a user
watches within that time. Without a watermark a key is a (user, video).

* rows are folded into the open sessions of a (user, video) (intervals that grow and merge),
  so what a micro-batch holds of a key is its sessions, not its events;
* a session with a later one of its (user, video) behind the gap is emitted ("gap");
* the open session is emitted when the watermark, moved by any user's rows, has passed
  its end ("watermark"): at its next rows or at the key's timer, which looks every
  ``check_ms``. Only keys with open sessions have a timer;
* every update sets the idle time to ``now + delay`` (wall clock, not the
  reference's event-time-based timer: SURVEY Q18); when it has passed, the open session
  is emitted ("idle");
* the end of the last emitted session stays known: a row within ``gap`` of
  it, or before it, belongs to what was counted already and is late (dropped). A
  session is never emitted twice nor reopened, so job 2 can't count it twice.
  A row whose own window has expired under the watermark is late too.

Choose ``delay`` longer than the time between micro-batches: an idle close is a
decision, rows of the same session that come after it are late.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from datetime import datetime
from typing import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from watchtally.operators.sessions import event_time

# the videos of a key as a JSON list (Spark takes about a millisecond to write a nested value of
# Python's) of [resourceId, n, t0, t1, level, video_length, end of the last emitted session,
# wall clock at which the open one is idle]
STATE_SCHEMA = T.StructType([T.StructField("watches", T.StringType())])

OUTPUT_SCHEMA = T.StructType([
    T.StructField("userCode", T.StringType()),
    T.StructField("resourceId", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("t0", T.LongType()),
    T.StructField("t1", T.LongType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("video_length", T.IntegerType()),
    T.StructField("closed_by", T.StringType()),
])


class IdleFlushProcessor(StatefulProcessor):
    """``by_watermark``: the query has a watermark, which closes sessions too."""

    def __init__(self, gap_ms: int, delay_ms: int, by_watermark: bool = False,
                 check_ms: int = 1000):
        self.gap_ms = int(gap_ms)
        self.delay_ms = int(delay_ms)
        self.check_ms = int(check_ms) if by_watermark else int(delay_ms)
        self.by_watermark = by_watermark

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("watches", STATE_SCHEMA)

    def _emit(self, user, video, s, how) -> Row:
        return Row(userCode=user, resourceId=video, n=int(s[0]), t0=int(s[1]),
                   t1=int(s[2]), level=s[3], video_length=s[4], closed_by=how)

    def _store(self, watches: dict, watermark: int | None) -> None:
        """Keep what later rows need: open sessions, and ends that the watermark hasn't left behind."""
        kept = [(video, *w) for video, w in watches.items()
                if w[0] or watermark is None or w[5] + 2 * self.gap_ms > watermark]
        if kept:
            self.state.update((json.dumps(kept),))
        else:
            self.state.clear()

    def _watermark(self, timer_values) -> int | None:
        return timer_values.getCurrentWatermarkInMs() if self.by_watermark else None

    def _passed(self, t1: int, watermark: int | None) -> bool:
        return watermark is not None and t1 + self.gap_ms <= watermark

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.state.get()
        watches = {} if old is None else {w[0]: tuple(w[1:]) for w in json.loads(old[0])}
        watermark, now = self._watermark(timerValues), timerValues.getCurrentProcessingTimeInMs()
        had_timer = any(w[0] for w in watches.values())
        # by video: sessions (n, t0, t1, level, video_length) in time order, more than a gap apart
        found: dict = {}
        for r in rows:
            ts, video = int(r["ts"]), r["resourceId"]
            w = watches.get(video)
            if video not in found:
                runs = [list(w[:5])] if w is not None and w[0] else []
                found[video] = runs, [s[1] for s in runs]
            emitted = w[5] if w is not None else None
            if emitted is not None and ts - emitted <= self.gap_ms or self._passed(ts, watermark):
                continue                                  # late
            _fold(*found[video], [1, ts, ts, r["level"], r["video_length"]], self.gap_ms)
        for video, (runs, _) in found.items():
            emitted = watches[video][5] if video in watches else None
            for k, s in enumerate(runs):
                if k < len(runs) - 1 or self._passed(s[2], watermark):
                    emitted = int(s[2])
                    yield self._emit(key[0], video, s, "gap" if k < len(runs) - 1 else "watermark")
            if runs and int(runs[-1][2]) != emitted:
                watches[video] = (*runs[-1], emitted, now + self.delay_ms)
            elif emitted is not None:
                watches[video] = (0, None, None, None, None, emitted, None)
        if not had_timer and any(w[0] for w in watches.values()):
            self.handle.registerTimer(now + min(self.check_ms, self.delay_ms))
        self._store(watches, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        old = self.state.get()
        watches = {} if old is None else {w[0]: tuple(w[1:]) for w in json.loads(old[0])}
        watermark, now = self._watermark(timerValues), timerValues.getCurrentProcessingTimeInMs()
        dues, closed = [], False
        for video, w in watches.items():
            if not w[0]:
                continue                                  # closed meanwhile
            passed = self._passed(int(w[2]), watermark)
            if passed or now >= w[6]:
                closed = True
                watches[video] = (0, None, None, None, None, int(w[2]), None)
                yield self._emit(key[0], video, w, "watermark" if passed else "idle")
            else:
                dues.append(int(w[6]))
        if dues:
            self.handle.registerTimer(min(min(dues), now + self.check_ms))
        if closed:
            self._store(watches, watermark)

    def close(self) -> None:
        pass


def _fold(runs: list[list], starts: list[int], new: list, gap_ms: int) -> None:
    """Merge one event into sorted sessions that lie more than a gap apart."""
    lo = hi = bisect_right(starts, new[1])
    if lo and new[1] - runs[lo - 1][2] <= gap_ms:
        lo -= 1
    if hi < len(runs) and runs[hi][1] - new[2] <= gap_ms:
        hi += 1
    near = sorted([*runs[lo:hi], new], key=lambda s: (s[1], s[3] or 0, s[4] or 0))
    runs[lo:hi] = [[sum(s[0] for s in near), near[0][1], max(s[2] for s in near), *near[0][3:5]]]
    starts[lo:hi] = [near[0][1]]


def run_until_idle(out: DataFrame, spark, base: str, delay_ms: int,
                   partitions: int | None = None) -> DataFrame:
    """Run an idle-flush stream into files until its input is read and every idle timer
    that the input set has come due, then stop it and return the output."""
    import time
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if partitions:
        spark.conf.set(key, str(partitions))
    try:
        q = (out.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out")
             .trigger(processingTime="1 second").start())
    finally:
        spark.conf.set(key, before)

    def last():
        if q.exception():
            raise q.exception()
        time.sleep(0.3)
        return q.lastProgress

    try:
        while (p := last()) is None or any(x.startOffset != x.endOffset for x in p.sources):
            pass                                          # input is still being read
        due = time.time() + delay_ms / 1000
        # until a trigger that began after every timer was due has ended
        while datetime.fromisoformat(last().timestamp.replace("Z", "+00:00")).timestamp() <= due:
            pass
    finally:
        q.stop()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def idle_flush_sessions(dwd: DataFrame, gap_ms: int, delay_ms: int,
                        watermark_delay: str | None = None, check_ms: int = 1000) -> DataFrame:
    """Sessions per (user, video) closed by a gap, by ``delay_ms`` of idleness or, with a
    ``watermark_delay``, by the watermark, whichever comes first.

    The watermark is set on a row's window end, ``ts + gap``, with a delay longer by the
    gap: it has the same value, and a row is late only once its own window has expired.
    """
    ev = event_time(dwd).select("userCode", "resourceId", "ts", "level", "video_length",
                                F.timestamp_millis(F.col("ts") + int(gap_ms)).alias("closes"))
    if watermark_delay is not None:
        ev = ev.withWatermark("closes", f"{watermark_delay} {int(gap_ms)} milliseconds")
    keys = ["userCode"] if watermark_delay is not None else ["userCode", "resourceId"]
    return (ev.groupBy(*keys)
              .transformWithState(
                  statefulProcessor=IdleFlushProcessor(gap_ms, delay_ms, watermark_delay is not None, check_ms),
                  outputStructType=OUTPUT_SCHEMA,
                  outputMode="Append",
                  timeMode="ProcessingTime"))

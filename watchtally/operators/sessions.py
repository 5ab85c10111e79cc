"""Event-time sessions per (user, video) and watch metrics.

A session is a maximal run of events of one key whose consecutive timestamps
differ by at most ``gap`` (a difference equal to the gap stays in the same
session, like touching session windows). Each session reports

* ``logCount``     events in the session                       (A1)
* ``duration``     ``logCount * ms_per_event`` as bigint        (A2, Q14, Q19)
* ``level``, ``videoLength`` of the earliest event              (A3)
* ``videoPercent`` ``round_half_up(duration*100/videoLength)/100`` (A4, F3)
* ``s0`` / ``s1``  first event time / last event time + gap (window end)

Batch form (skew-proof, no per-key buffering of raw events)
-----------------------------------------------------------
1. *Gap cells*: ``floor(ts / gap)``. Two events of one cell are less than a
   gap apart, so they always share a session. ``groupBy(key, cell)`` is an
   ordinary aggregate with map-side partial aggregation, so a hot key's
   dense events collapse before the shuffle. After it, a key has at most
   ``time span / gap`` rows whatever its event volume.
2. *Fragments*: cells are grouped into time buckets of ``bucket`` width;
   gaps-and-islands (``lag`` + running sum) inside each (key, bucket) gives
   fragments. A window group holds at most ``bucket / gap`` cells, and a hot
   key is spread over many buckets, so over many tasks.
3. *Stitching*: only a bucket's first and last fragment can touch another
   bucket. Those (at most two per bucket) are stitched per key with a second
   gaps-and-islands pass; interior fragments are already whole sessions.

Streaming form
--------------
``session_window`` on an event-time column with a watermark, Spark's own
merging session state (merged inside each input partition before the
shuffle, see ``watchtally.session``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchtally.functions.scalar import half_up

KEYS = ["userCode", "resourceId"]
FIRST_COLS = ("level", "video_length")      # taken from a session's earliest event
DAY_MS = 86_400_000
BUCKET_GAPS = 64
# Fixed values that must equal the reference: the session gap of job 2 and the
# watch time one event stands for.
REFERENCE_GAP_MS = 11_000
REFERENCE_MS_PER_EVENT = 1_000


def _floordiv(col: str, d: int) -> Column:
    """Exact floor division of a bigint column (correct for negatives too)."""
    return F.expr(f"({col} - pmod({col}, {int(d)})) div {int(d)}")


def event_time(dwd: DataFrame, name: str = "et") -> DataFrame:
    """T1 + P13 on job 2's input: a missing ``ts`` reads as 0 (event time), and
    so do a missing ``level`` / ``video_length`` (primitive getters); a 0
    length later goes to the quarantine branch, a 0 level matches level-0 rules."""
    ts = F.coalesce(F.col("ts"), F.lit(0).cast("bigint"))
    out = dwd.withColumn("ts", ts)
    for c in FIRST_COLS:
        if c in dwd.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out.withColumn(name, F.timestamp_millis(ts))


def _first_values(cols=FIRST_COLS) -> list[Column]:
    # A3: values of the earliest event. ``min_by`` keeps fixed-width buffers,
    # so the aggregate stays a hash aggregate (a struct ``min`` would force a
    # sort-based one). Events tied on the same millisecond may give either
    # value, like the reference's arrival order.
    return [F.min_by(c, "ts").alias(c) for c in cols]


def _gaps_and_islands(df: DataFrame, part: list[str], gap_ms: int,
                      out: str, count_runs: bool = False) -> DataFrame:
    """Number runs of rows ordered by t0 where t0 - previous t1 <= gap;
    optionally also the number of runs in the partition (``_nrun``)."""
    w = Window.partitionBy(*part).orderBy("t0")
    prev = F.col("_prev")
    brk = F.when(prev.isNull() | ((F.col("t0") - prev) > F.lit(gap_ms)), 1).otherwise(0)
    df = (df.withColumn("_prev", F.lag("t1").over(w))
            .withColumn("_brk", brk)
            .withColumn(out, F.sum("_brk").over(
                w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    if count_runs:
        df = df.withColumn("_nrun", F.sum("_brk").over(Window.partitionBy(*part)))
    return df.drop("_brk", "_prev")


def _merge_aggs(cols=FIRST_COLS) -> list[Column]:
    # cells / fragments of one key never share a t0, so min_by is exact here
    return [F.sum("n").alias("n"), F.min("t0").alias("t0"), F.max("t1").alias("t1"),
            *[F.min_by(c, "t0").alias(c) for c in cols]]


def raw_sessions(dwd: DataFrame, gap_ms: int = REFERENCE_GAP_MS,
                 bucket_ms: int | None = None, first_cols=FIRST_COLS) -> DataFrame:
    """Batch sessions: (userCode, resourceId, n, t0, t1, *first_cols) per session;
    ``first_cols`` are taken from the session's earliest event."""
    first_cols = tuple(first_cols)
    gap_ms = int(gap_ms)
    if gap_ms < 1:
        raise ValueError("gap must be at least 1 ms")
    if bucket_ms is None:
        # a day, or 64 gaps for long gaps: a window group holds at most
        # max(day/gap, 64) cells, and only a bucket's two edge fragments are
        # stitched again
        bucket_ms = max(DAY_MS, BUCKET_GAPS * gap_ms)
    cells_per_bucket = max(1, -(-int(bucket_ms) // gap_ms))

    ev = event_time(dwd).select(*KEYS, "ts", *first_cols)
    cells = (ev.withColumn("_cell", _floordiv("ts", gap_ms))
               .groupBy(*KEYS, "_cell")
               .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"),
                    F.max("ts").alias("t1"), *_first_values(first_cols)))

    bucketed = cells.withColumn("_bucket", _floordiv("_cell", cells_per_bucket))
    numbered = _gaps_and_islands(bucketed, KEYS + ["_bucket"], gap_ms, "_frag",
                                 count_runs=True)
    edge = (F.col("_frag") == 1) | (F.col("_frag") == F.col("_nrun"))
    frags = (numbered.withColumn("_edge", edge)
                     .groupBy(*KEYS, "_bucket", "_frag", "_edge")
                     .agg(*_merge_aggs(first_cols)))

    cols = [*KEYS, "n", "t0", "t1", *first_cols]
    interior = frags.where(~F.col("_edge")).select(*cols)
    edges = frags.where(F.col("_edge")).select(*cols)
    stitched = (_gaps_and_islands(edges, KEYS, gap_ms, "_sid")
                .groupBy(*KEYS, "_sid").agg(*_merge_aggs(first_cols)).select(*cols))
    return interior.unionByName(stitched)


def stream_raw_sessions(dwd: DataFrame, gap_ms: int = REFERENCE_GAP_MS,
                        watermark_delay: str = "0 seconds") -> DataFrame:
    """T2/T3 streaming form: watermark + ``session_window`` aggregation.

    Works on batch DataFrames too (without the watermark) and gives the same
    sessions as :func:`raw_sessions`. A stream merges the sessions of each input
    partition before the shuffle; a batch merges gap cells instead, so that a hot
    key's events are reduced before they meet in one task.
    """
    ev = event_time(dwd)
    if not dwd.isStreaming:
        cells = (ev.withColumn("_cell", _floordiv("ts", int(gap_ms))).groupBy(*KEYS, "_cell")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"), F.max("ts").alias("t1"),
                      *_first_values()))
        gap = F.concat((F.col("t1") - F.col("t0") + F.lit(int(gap_ms))).cast("string"),
                       F.lit(" milliseconds"))
        timed = cells.withColumn("et", F.timestamp_millis("t0"))
        return timed.groupBy(*KEYS, F.session_window("et", gap).alias("sw")).agg(*_merge_aggs(FIRST_COLS))
    ev = ev.withWatermark("et", watermark_delay)
    g = ev.groupBy(*KEYS, F.session_window("et", f"{int(gap_ms)} milliseconds").alias("sw"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"),
                 F.max("ts").alias("t1"), *_first_values())


def session_rows(raw: DataFrame, gap_ms: int = REFERENCE_GAP_MS,
                 ms_per_event: int = REFERENCE_MS_PER_EVENT) -> DataFrame:
    """T4: per-session metrics, all sessions (valid and not)."""
    n = F.col("n").cast("bigint")
    duration = n * F.lit(int(ms_per_event))
    vlen = F.col("video_length")
    # Guard before dividing (ANSI mode raises on /0); invalid lengths go to
    # the quarantine branch instead of producing Infinity.
    pct = F.when(vlen > 0, half_up(duration * F.lit(100.0) / vlen) / F.lit(100.0))
    return raw.select(
        F.col("userCode"),
        F.col("level").alias("level"),
        F.col("resourceId").alias("videoId"),
        n.alias("logCount"),
        duration.alias("duration"),
        vlen.alias("videoLength"),
        pct.alias("videoPercent"),
        F.col("t0").alias("s0"),
        (F.col("t1") + F.lit(int(gap_ms))).alias("s1"),
    )


def session_metrics(dwd: DataFrame, gap_ms: int = REFERENCE_GAP_MS,
                    ms_per_event: int = REFERENCE_MS_PER_EVENT,
                    bucket_ms: int | None = None) -> DataFrame:
    """Sessions with a usable video length (the main branch)."""
    raw = (stream_raw_sessions(dwd, gap_ms) if dwd.isStreaming
           else raw_sessions(dwd, gap_ms, bucket_ms))
    return session_rows(raw, gap_ms, ms_per_event).where(F.col("videoLength") > 0)


def session_quarantine(dwd: DataFrame, gap_ms: int = REFERENCE_GAP_MS,
                       ms_per_event: int = REFERENCE_MS_PER_EVENT) -> DataFrame:
    """Sessions whose video length is null or not positive."""
    raw = (stream_raw_sessions(dwd, gap_ms) if dwd.isStreaming
           else raw_sessions(dwd, gap_ms))
    rows = session_rows(raw, gap_ms, ms_per_event)
    return rows.where(F.col("videoLength").isNull() | (F.col("videoLength") <= 0))

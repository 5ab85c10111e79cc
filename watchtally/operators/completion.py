"""A5, A6, P14, T7 (batch form), S11: accumulate progress, complete once.

Per (user, video, task), in session order:

* running ``videoLength`` and ``videoPercent`` sums (A5; by default the
  video's full length is accumulated, as the reference does: SURVEY Q2),
* thresholds frozen at the first session of the key (A6, Q3),
* the key completes at the first session where both running sums reach the
  thresholds (P14); later sessions leave the state untouched (T7c).

Rows with a null threshold go to :func:`threshold_quarantine` and never
complete (SURVEY Q10).

Scale: the windows are partitioned by the full (user, video, task) key over
*sessions*; a key holds at most ``time span / gap`` sessions (see
``operators.sessions``), whatever the raw event volume. Both windows share
one exchange and one sort; the state aggregate reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchtally.functions.scalar import VIDEO
from watchtally.operators.rules import threshold_check

KEY = ["userCode", "videoId", "taskCode"]
MEASURES = {"video_length": "videoLength", "duration": "duration"}


def threshold_quarantine(matched: DataFrame) -> DataFrame:
    return matched.where(F.col("ruleLength").isNull() | F.col("rulePercent").isNull())


def running_progress(matched: DataFrame, measure: str = "video_length") -> DataFrame:
    """Running state of every key up to and including its completion."""
    src = MEASURES[measure]
    m = matched.where(F.col("ruleLength").isNotNull() & F.col("rulePercent").isNotNull())
    w = Window.partitionBy(*KEY).orderBy("s0")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    run = m.select(
        *KEY, "s0",
        F.row_number().over(w).alias("seq"),
        F.sum(F.col(src).cast("bigint")).over(upto).alias("videoLength"),
        F.sum("videoPercent").over(upto).alias("videoPercent"),
        F.first("ruleLength").over(upto).alias("ruleLength"),
        F.first("rulePercent").over(upto).alias("rulePercent"),
    )
    run = run.withColumn("complete", threshold_check("videoLength", "videoPercent",
                                                     "ruleLength", "rulePercent"))
    earlier = F.coalesce(F.sum(F.col("complete").cast("int")).over(before), F.lit(0))
    return run.withColumn("_earlier", earlier).where(F.col("_earlier") == 0).drop("_earlier")


def completions(matched: DataFrame, measure: str = "video_length") -> DataFrame:
    """One row per completed key, at the session that completed it."""
    return running_progress(matched, measure).where(F.col("complete"))


def completion_once(matched: DataFrame, measure: str = "video_length") -> DataFrame:
    """Flagship result rows: (userCode, taskCode, eventType, videoId), once per key."""
    return completions(matched, measure).select(
        "userCode", "taskCode", F.lit(VIDEO).alias("eventType"), "videoId")


def completion_first(matched: DataFrame, measure: str = "video_length") -> DataFrame:
    """Keys completed by their very first session."""
    return (completions(matched, measure).where(F.col("seq") == 1)
            .select("userCode", "taskCode", F.lit(VIDEO).alias("eventType"), "videoId"))


def completion_state(matched: DataFrame, measure: str = "video_length") -> DataFrame:
    """Final stored state of every key (frozen once complete)."""
    run = running_progress(matched, measure)
    # one fixed-width max_by per column keeps this a hash aggregate; it reuses
    # the window's partitioning, so it adds no exchange
    cols = ["complete", "videoLength", "videoPercent", "ruleLength", "rulePercent"]
    return run.groupBy(*KEY).agg(*[F.max_by(c, "s0").alias(c) for c in cols])

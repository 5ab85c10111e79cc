"""Composite pipelines over any inputs, batch form.

``Inputs`` bundles the raw log and the four dimensions; the fixture loader
builds it from the test tables, production code from ``watchtally.sources``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtally.operators import clean, completion, enrich, rules, sessions
from watchtally.operators.broadcast import bounded_broadcast
from watchtally.sources import fixtures


@dataclass
class Inputs:
    raw: DataFrame          # value: string (+ optional carried columns)
    doctor: DataFrame
    video: DataFrame
    rule: DataFrame
    task: DataFrame
    gap_ms: int = sessions.REFERENCE_GAP_MS
    carry: tuple[str, ...] = ()

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        d = fixtures.dims(spark, sf_dir)
        return cls(fixtures.raw_log(spark, sf_dir), d["doctor_info"], d["video_info"],
                   d["credit_rule_config"], d["credit_task"],
                   gap_ms=fixtures.FIXTURE_GAP_MS, carry=("event_id",))


def parsed(i: Inputs) -> DataFrame:
    return clean.parse_log(i.raw)


def clean_log(i: Inputs) -> DataFrame:
    return clean.clean_branch(parsed(i), i.carry)


def dirty_log(i: Inputs) -> DataFrame:
    return clean.dirty_branch(parsed(i), i.carry)


def dwd_video_wide(i: Inputs, carry: bool = True) -> DataFrame:
    """Job 1: clean -> + level -> video events -> + video length."""
    keep = i.carry if carry else ()
    return enrich.dwd_video_wide(clean_log(i), i.doctor, i.video, keep=keep)


def _late(raw: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str) -> DataFrame:
    """Join a dimension to sessions as if it had been joined to their events."""
    dim = dim.select(dim_key, value)
    one = bounded_broadcast(dim.groupBy(dim_key).agg(F.min(value).alias(value),
                                                     F.count(F.lit(1)).alias("_times")), source=dim)
    return (raw.join(one, raw[key] == one[dim_key], "inner")
               .withColumn("n", F.col("n") * F.col("_times")).drop(dim_key, "_times"))


def session_metrics(i: Inputs, bucket_ms: int | None = None,
                    late_join: bool = True) -> DataFrame:
    """Sessions with a usable video length (see :func:`all_sessions`)."""
    return all_sessions(i, bucket_ms, late_join).where(F.col("videoLength") > 0)


def session_quarantine(i: Inputs) -> DataFrame:
    """Sessions whose video length is missing or not positive."""
    length = F.col("videoLength")
    return all_sessions(i).where(length.isNull() | (length <= 0))


def all_sessions(i: Inputs, bucket_ms: int | None = None, late_join: bool = True) -> DataFrame:
    """Jobs 1+2 in batch: sessions per (user, video) with watch metrics.

    ``late_join`` (default) sessionizes the clean video events first and joins
    the user and video dimensions to the *sessions*. Catalyst does not move a
    join above an aggregation by itself; doing it here means the possibly
    large user dimension is joined to sessions, not to every event, which
    removes an event-level shuffle when that dimension is too large to
    broadcast. It gives the same rows as the event-level order because the
    session key contains both join keys: a session's events share one user and
    one video, and unknown ones drop whole sessions. Keys are declared unique but
    not enforced, so each dimension is reduced to one row per key with its
    multiplicity, by which an event-level join would repeat every event.
    """
    if not late_join:
        raw = sessions.raw_sessions(dwd_video_wide(i, carry=False), i.gap_ms, bucket_ms)
        return sessions.session_rows(raw, i.gap_ms)
    video_events = enrich.filter_video(clean_log(i)).select("userCode", "resourceId", "ts")
    raw = sessions.raw_sessions(video_events, i.gap_ms, bucket_ms, first_cols=())
    raw = _late(_late(raw, i.doctor, "userCode", "user_id", "level"),
                i.video, "resourceId", "video_id", "video_length")
    raw = raw.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in sessions.FIRST_COLS
                       else F.col(c) for c in raw.columns])    # P13 as in job 2's input
    return sessions.session_rows(raw, i.gap_ms)


def rule_match(i: Inputs, by_key: bool = False) -> DataFrame:
    """``by_key`` deals the sessions by (user, video) before the rule join, so that
    windows per (user, video, task) need no shuffle of the joined rows."""
    s = session_metrics(i)
    if by_key:
        s = s.repartition("userCode", "videoId")
    return rules.rule_match(s, i.rule, i.task)


def completion_once(i: Inputs, measure: str = "video_length") -> DataFrame:
    """Flagship: each completed (user, video, task) exactly once."""
    return completion.completion_once(rule_match(i, by_key=True), measure)

"""Structured Streaming forms of the two jobs.

Job 1 (clean, split, enrich, publish) runs as ``foreachBatch`` so that one
micro-batch is parsed once and feeds both the dirty and the enriched sink,
and so the dimension sides can be refreshed on a TTL (J6/J7).

Job 2 is two queries with a topic of matched sessions between them:

* sessions: watermark -> ``session_window`` aggregation (or the idle processor of T6) ->
  ``foreachBatch`` that joins rules and tasks from a TTL cache, so a change of theirs
  counts without a restart, and writes every output of the epoch: the matched sessions,
  both quarantines and the printed stages come from one session state;
* completion: matched sessions -> keyed state (``transformWithState``) -> result sink.
  A session that the topic holds twice (a retried epoch) is counted once.

:func:`completion_stream` is both in one query, over static rules and tasks.
"""

from __future__ import annotations

from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtally.operators.clean import clean_branch, dirty_branch, parse_log
from watchtally.operators.completion import threshold_quarantine
from watchtally.operators.enrich import dwd_video_wide
from watchtally.operators.rules import each_task, match_tasks, with_tasks
from watchtally.operators.sessions import (
    REFERENCE_GAP_MS, REFERENCE_MS_PER_EVENT, session_rows, stream_raw_sessions,
)
from watchtally.operators.sinks import to_json_value
from watchtally.sources.dims import DimensionCache
from watchtally.streaming.completion import apply_completion
from watchtally.streaming.idle import idle_flush_sessions
from watchtally.streaming.state import print_rows


def session_stream(dwd: DataFrame, gap_ms: int = REFERENCE_GAP_MS,
                   watermark_delay: str = "0 seconds",
                   ms_per_event: int = REFERENCE_MS_PER_EVENT) -> DataFrame:
    """Closed sessions of a dwd stream (late rows dropped by the watermark).

    A row is late when its own window ``[ts, ts + gap)`` ended before the
    watermark. Rows of one micro-batch are merged inside their input partition
    first, so a late row that joins a still-open session of the same batch is
    kept (the reference's merging windows keep it too when it arrives after
    its neighbour).
    """
    raw = stream_raw_sessions(dwd, gap_ms, watermark_delay)
    return session_rows(raw, gap_ms, ms_per_event).where(F.col("videoLength") > 0)


MATCHED_SCHEMA = ("userCode string, level int, videoId string, logCount bigint, duration bigint, "
                  "videoLength int, videoPercent double, s0 bigint, s1 bigint, "
                  "tasks array<struct<taskCode:string,ruleCode:string,ruleLength:int,rulePercent:double>>")
JOB2_LABELS = ("sessions", "rule_match")


def closed_sessions(dwd: DataFrame, gap_ms: int = REFERENCE_GAP_MS,
                    watermark_delay: str = "0 seconds",
                    idle_delay_ms: int | None = None) -> DataFrame:
    """All closed sessions of a stream, valid or not: by the watermark (T2/T3), with
    ``idle_delay_ms`` also after that long without events (T6)."""
    raw = (stream_raw_sessions(dwd, gap_ms, watermark_delay) if idle_delay_ms is None
           else idle_flush_sessions(dwd, gap_ms, idle_delay_ms, watermark_delay))
    return session_rows(raw, gap_ms)


def job2_batch_writer(tasks: DimensionCache, write_matched: Callable[[DataFrame, int], None],
                      aside: dict[str, Callable[[DataFrame, int], None]] | None = None,
                      show: tuple[str, ...] = ()):
    """``foreachBatch`` body of job 2's sessions query; ``tasks`` caches
    :func:`watchtally.operators.rules.level_tasks`.

    ``aside`` takes what the result leaves out: "session_quarantine" (Q5) and
    "threshold_quarantine" (Q10). ``show`` names stages that are printed (S8). Matched sessions
    are dealt by (user, video), so those of one key reach the topic in one file, in order.
    """
    aside = aside or {}
    unknown = set(show) - set(JOB2_LABELS)
    if unknown:
        raise ValueError(f"unknown print labels: {sorted(unknown)}")

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            length = F.col("videoLength")
            matched = with_tasks(rows.where(length > 0), tasks.get())
            outputs = {"session_quarantine": lambda: rows.where(length.isNull() | (length <= 0)),
                       "threshold_quarantine": lambda: threshold_quarantine(each_task(matched))}
            for name, write in aside.items():
                write(outputs[name](), epoch_id)
            if "sessions" in show:
                print_rows(rows.where(length > 0), f"sessions {epoch_id}")
            if "rule_match" in show:
                print_rows(each_task(matched), f"rule_match {epoch_id}")
            write_matched(matched.repartition("userCode", "videoId"), epoch_id)
        finally:
            rows.unpersist()
    return run


def matched_topic(lines: DataFrame) -> DataFrame:
    """The sessions that :func:`job2_batch_writer` published as JSON records."""
    return lines.select(F.from_json("value", MATCHED_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def completion_stream(dwd: DataFrame, rule: DataFrame, task: DataFrame,
                      gap_ms: int = REFERENCE_GAP_MS, watermark_delay: str = "0 seconds",
                      measure: str = "video_length",
                      state_ttl_ms: int | None = None) -> DataFrame:
    """Job 2 end to end: one output row per completed (user, video, task)."""
    sessions = session_stream(dwd, gap_ms, watermark_delay)
    matched = match_tasks(sessions, rule, task)
    col = "videoLength" if measure == "video_length" else "duration"
    return apply_completion(matched, col, state_ttl_ms)


def job1_batch_writer(doctor: DimensionCache, video: DimensionCache,
                      write_wide: Callable[[DataFrame, int], None],
                      write_dirty: Callable[[DataFrame, int], None],
                      show: tuple[str, ...] = ()):
    """``foreachBatch`` body of job 1.

    The micro-batch is parsed once and persisted; the dirty branch and the
    enriched branch (as JSON topic records) are written from it; the
    dimension sides come from TTL caches (bounded staleness, no row cap).
    ``show`` names branches ("dirty", "video") whose rows are printed, every one and
    whole, under their label (S8).
    """
    unknown = set(show) - {"dirty", "video"}
    if unknown:
        raise ValueError(f"unknown print labels: {sorted(unknown)}")

    def run(batch: DataFrame, epoch_id: int) -> None:
        parsed = parse_log(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dirty = dirty_branch(parsed)
            wide = dwd_video_wide(clean_branch(parsed), doctor.get(), video.get())
            for label, df in (("dirty", dirty), ("video", wide)):
                if label in show:
                    print_rows(df, f"{label} {epoch_id}")
            write_dirty(dirty, epoch_id)
            write_wide(to_json_value(wide), epoch_id)
        finally:
            parsed.unpersist()
    return run

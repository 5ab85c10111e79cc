"""Add user level and video length to video events.

All joins are inner equi-joins (unknown users or videos drop out, as in the
reference's lookup joins). Both dimensions are broadcast only behind a
row-count check; the user dimension can be as large as the user base, and
above the bound it is joined with a sort-merge join (AQE splits a hot user's
partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtally.functions.scalar import VIDEO
from watchtally.operators.broadcast import DEFAULT_MAX_ROWS, bounded_broadcast

DWD_COLUMNS = ["deviceId", "userCode", "eventCode", "ts", "resourceId", "level",
               "video_length"]


def with_proctime(df: DataFrame, name: str = "pt") -> DataFrame:
    """Processing-time column (one value per query / micro-batch)."""
    return df.withColumn(name, F.current_timestamp())


def filter_video(log: DataFrame) -> DataFrame:
    """Keep video events only."""
    return log.where(F.col("eventType") == F.lit(VIDEO))


def lookup_doctor(log: DataFrame, doctor: DataFrame,
                  max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """+ ``level`` from doctor_info on userCode = user_id."""
    d = bounded_broadcast(doctor, max_broadcast_rows).select("user_id", "level")
    return log.join(d, log["userCode"] == d["user_id"], "inner").drop("user_id")


def lookup_video(log: DataFrame, video: DataFrame,
                 max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """+ ``video_length`` from video_info on resourceId = video_id."""
    v = bounded_broadcast(video, max_broadcast_rows).select("video_id", "video_length")
    return log.join(v, log["resourceId"] == v["video_id"], "inner").drop("video_id")


def dwd_video_wide(log: DataFrame, doctor: DataFrame, video: DataFrame,
                   max_broadcast_rows: int = DEFAULT_MAX_ROWS,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Job 1 body after cleaning: level, then video length for video events.

    The ``eventType`` filter is written after the user lookup like the
    reference; Catalyst pushes it below both joins (and into the scan).
    """
    leveled = lookup_doctor(log, doctor, max_broadcast_rows)
    wide = lookup_video(filter_video(leveled), video, max_broadcast_rows)
    return wide.select(*DWD_COLUMNS, *keep)

"""Spread an input with fewer splits than cores before CPU-heavy per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the default parallelism when its scan has fewer
    splits than that (e.g. one small file = one task for the JSON parse).

    Large inputs already have at least as many splits as cores; they are
    returned unchanged, so they never pay for this extra shuffle.
    """
    if df.isStreaming:
        return df
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no driver-side context (e.g. a Spark Connect session)
        return df
    return df if splits >= cores else df.repartition(cores)

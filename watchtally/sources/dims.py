"""Dimension tables and their time-bounded reload.

Dimensions are read with an explicit schema (no inference) from JDBC or
files. A streaming job joins them as static sides; Spark fixes a static
side's contents when its DataFrame is built, so "lookup as of now" with a
bounded staleness (the reference caches lookups for one hour) is done by
:class:`DimensionCache` inside ``foreachBatch``.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from watchtally import schemas

DIMENSIONS = {
    "doctor_info": schemas.DOCTOR_INFO,
    "video_info": schemas.VIDEO_INFO,
    "credit_rule_config": schemas.CREDIT_RULE_CONFIG,
    "credit_task": schemas.CREDIT_TASK,
}

# Fixed value that must equal the reference: lookups may be one hour stale.
DEFAULT_TTL_SECONDS = 3600


def read_dim(spark: SparkSession, name: str, fmt: str = "parquet",
             path: str | None = None, options: dict | None = None) -> DataFrame:
    """One dimension with its declared schema.

    ``fmt="jdbc"`` expects ``url``, ``dbtable`` (defaults to ``name``) and
    credentials in ``options``; nothing is hard-coded here.
    """
    schema = DIMENSIONS[name]
    opts = dict(options or {})
    if fmt == "jdbc":
        opts.setdefault("dbtable", name)
        df = spark.read.format("jdbc").options(**opts).load()
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    r = spark.read.format(fmt).options(**opts)
    if fmt not in ("parquet", "orc", "delta"):
        r = r.schema(schema)
    df = r.load(path)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


class DimensionCache:
    """A dimension kept in executor storage and reloaded once older than ttl.

    Use it inside ``foreachBatch``: ``dim = cache.get()`` for each micro-batch.
    There is no row cap: the whole table is cached (spilling to disk when large)
    and refreshed as a unit, which bounds staleness like the reference's TTL.
    ``partition_by`` keeps a large dimension hash-partitioned on its join key.
    """

    def __init__(self, loader, ttl_seconds: float = DEFAULT_TTL_SECONDS, clock=time.monotonic,
                 partition_by: list[str] | None = None):
        self._loader = loader
        self._partition_by = partition_by
        self._ttl = ttl_seconds
        self._clock = clock
        self._df: DataFrame | None = None
        self._loaded_at = 0.0
        self.loads = 0

    def get(self) -> DataFrame:
        now = self._clock()
        if self._df is None or now - self._loaded_at >= self._ttl:
            if self._df is not None:
                # before the new one is kept: Spark takes a second read of the same path for
                # the cached table, and would go on with its rows
                self._df.unpersist()
            df = self._loader()
            if self._partition_by:
                # hash-partitioned once per load: a shuffle join against it then
                # moves only the micro-batch, not the whole dimension
                df = df.repartition(*self._partition_by)
            self._df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._loaded_at = now
            self.loads += 1
        return self._df

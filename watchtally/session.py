"""Spark session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Session zone UTC keeps epoch-millisecond
# arithmetic and the SQL oracles aligned; RocksDB keeps keyed streaming state
# off the JVM heap; merging sessions inside each input partition is the
# map-side pre-aggregation of session windows in streaming.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a repeated key in a log line keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_spark(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "watchtally", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster pass ``master=None``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    b = b.config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("WT_DRIVER_MEMORY", "8g"))
    for k, v in SQL_DEFAULTS.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_defaults(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the SQL settings above on an existing session (driver-made ones)."""
    for k, v in SQL_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings stay as the cluster set them
            pass


def job_folder(spark: SparkSession, name: str) -> str:
    """The folder of a named job, the same at every start (so a restart resumes).

    Spark appends a fresh folder name to ``spark.checkpoint.dir`` at each start of
    an application; a job's checkpoint therefore hangs on the configured folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        own = spark.sparkContext.getCheckpointDir()
        root = own.rstrip("/").rsplit("/", 1)[0] if own else None
    if not root:
        raise ValueError(f"job {name}: set spark.checkpoint.dir or the job's \"checkpoint\"")
    return f"{root.rstrip('/')}/watchtally-jobs/{name}"


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; in local mode a private one when unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # no driver-side context (e.g. a Spark Connect session)
        sc = None
    root = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="watchtally-ckpt-")
        if sc:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/watchtally/{name}-{uuid.uuid4().hex}"

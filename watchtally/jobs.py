"""Runnable applications: job 1, job 2 and the topic tail.

    python -m watchtally.jobs job1 --config job1.json
    python -m watchtally.jobs job2 --config job2.json
    python -m watchtally.jobs tail --config tail.json

A config names every source and sink by ``format`` + ``options`` (+ ``path``),
so the same job runs on Kafka/JDBC on a cluster and on files in tests; no
endpoint or credential is built in. Checkpoints default to a folder under
``spark.checkpoint.dir`` that depends on the job's name alone, so a restarted job
continues where it stopped.

job1:   raw log lines -> dirty lines sink + enriched video topic (dwd_video_info)
job2:   dwd topic -> sessions -> rules -> emit-once completion results (JSON), with
        quarantine, reject and print outputs
tail:   print (or keep) every line of a topic
replay: a line file -> a topic or any sink, as one batch job (no pacing)
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtally.operators.completion import MEASURES
from watchtally.operators.rules import level_tasks
from watchtally.operators.sessions import REFERENCE_GAP_MS
from watchtally.operators.sinks import replay_lines, result_json, to_json_value, write_stream
from watchtally.session import apply_defaults, build_spark, job_folder
from watchtally.sources.dims import DEFAULT_TTL_SECONDS, DimensionCache, read_dim
from watchtally.sources.logs import bad_dwd, good_dwd, parse_topic, read_lines
from watchtally.streaming.completion import apply_completion
from watchtally.streaming.flows import (
    JOB2_LABELS, closed_sessions, job1_batch_writer, job2_batch_writer, matched_topic,
)
from watchtally.streaming.state import print_rows, tail_topic


def _dim(spark: SparkSession, name: str, spec: dict) -> DataFrame:
    return read_dim(spark, name, spec.get("format", "parquet"), spec.get("path"),
                    spec.get("options"))


def epoch_writer(spec: dict):
    """``foreachBatch`` sink: file formats write ``<path>/epoch=<id>`` with overwrite,
    so a retried micro-batch replaces its own output (exactly once); other formats
    (kafka, jdbc) append."""
    fmt, path, opts = spec["format"], spec.get("path"), spec.get("options", {})

    def write(df: DataFrame, epoch_id: int) -> None:
        w = df.write.format(fmt).options(**opts)
        if path:
            w.mode("overwrite").save(f"{path.rstrip('/')}/epoch={epoch_id}")
        else:
            w.mode("append").save()
    return write


def _checkpoint(spark: SparkSession, cfg: dict, job: str) -> str:
    """The same folder at every start of a named job, so that it continues."""
    return cfg.get("checkpoint") or job_folder(spark, cfg.get("name", job)) + "/checkpoint"


def _trigger(cfg: dict) -> dict:
    return cfg.get("trigger", {"processingTime": "10 seconds"})


def start_job1(spark: SparkSession, cfg: dict):
    """Job 1 as a streaming query (foreachBatch: parse once, two sinks, TTL dims)."""
    src = cfg["source"]
    lines = read_lines(spark, src["format"], src.get("path"), src.get("options"), stream=True)
    ttl = cfg.get("dim_ttl_seconds", DEFAULT_TTL_SECONDS)
    doctor = DimensionCache(lambda: _dim(spark, "doctor_info", cfg["doctor_info"]), ttl,
                            partition_by=["user_id"])
    video = DimensionCache(lambda: _dim(spark, "video_info", cfg["video_info"]), ttl)
    body = job1_batch_writer(doctor, video, epoch_writer(cfg["wide_sink"]),
                             epoch_writer(cfg["dirty_sink"]), show=tuple(cfg.get("print", ())))
    ckpt = _checkpoint(spark, cfg, "job1")
    return (lines.writeStream.foreachBatch(body).option("checkpointLocation", ckpt)
                 .trigger(**_trigger(cfg)).queryName(cfg.get("name", "job1")).start())


class Queries:
    """Handle of a job of several queries: when one fails, the others are stopped and
    its error is raised."""

    def __init__(self, *queries):
        self.queries = list(queries)

    @property
    def isActive(self) -> bool:
        return any(q.isActive for q in self.queries)

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def awaitTermination(self, timeout: float | None = None) -> bool:
        end = None if timeout is None else time.monotonic() + timeout
        while True:
            failed = next((q for q in self.queries if q.exception()), None)
            if failed is not None:
                self.stop()
                raise failed.exception()
            running = [q for q in self.queries if q.isActive]
            if not running:
                return True
            left = 1.0 if end is None else min(1.0, end - time.monotonic())
            if left <= 0:
                return False
            try:
                running[0].awaitTermination(left)
            except Exception:
                self.stop()
                raise


def start_job2(spark: SparkSession, cfg: dict) -> Queries:
    """Job 2: sessions -> rules as of now -> topic of matched sessions -> emit-once state.

    Rules and tasks are re-read once they are ``dim_ttl_seconds`` old (J6/J7), between
    micro-batches and without a restart. ``reject_sink`` keeps the topic lines that are no
    record; without it such a line fails the job, unless ``strict`` is false.
    ``idle_delay_ms`` also closes sessions by the wall clock (T6).
    """
    src, name, ckpt = cfg["source"], cfg.get("name", "job2"), _checkpoint(spark, cfg, "job2")
    shown = set(cfg.get("print", ()))
    unknown = shown - {*JOB2_LABELS, "result"}
    if unknown:
        raise ValueError(f"unknown print labels: {sorted(unknown)}")
    once = "availableNow" in _trigger(cfg)
    lines = read_lines(spark, src["format"], src.get("path"), src.get("options"), stream=True)
    parsed = parse_topic(lines)
    running = []
    if "reject_sink" in cfg:
        own = cfg["reject_sink"]
        running.append(write_stream(bad_dwd(parsed), own["format"], f"{ckpt}-rejects", own.get("path"),
                                    own.get("options"), trigger=_trigger(cfg), query_name=f"{name} rejects"))
    dwd = good_dwd(parsed, strict=cfg.get("strict", "reject_sink" not in cfg))
    idle = cfg.get("idle_delay_ms")
    if idle is not None and once:
        raise ValueError("idle_delay_ms needs a processing-time trigger")
    rows = closed_sessions(dwd, cfg.get("gap_ms", REFERENCE_GAP_MS),
                           cfg.get("watermark_delay", "0 seconds"), idle)
    tasks = DimensionCache(
        lambda: level_tasks(_dim(spark, "credit_rule_config", cfg["credit_rule_config"]),
                            _dim(spark, "credit_task", cfg["credit_task"])),
        cfg.get("dim_ttl_seconds", DEFAULT_TTL_SECONDS))
    aside = {k: _rows_writer(cfg[f"{k}_sink"])
             for k in ("session_quarantine", "threshold_quarantine") if f"{k}_sink" in cfg}
    topic = cfg.get("matched_topic", {"format": "text", "path": f"{ckpt}-matched"})
    body = job2_batch_writer(tasks, _matched_writer(topic), aside, tuple(shown - {"result"}))
    sessions = (rows.writeStream.foreachBatch(body).option("checkpointLocation", f"{ckpt}-sessions")
                .trigger(**_trigger(cfg)).queryName(f"{name} sessions").start())
    running.append(sessions)
    if once:
        Queries(*running).awaitTermination()             # then all matched sessions are there
    read_options = topic.get("read_options", topic.get("options", {}))
    if topic.get("path"):
        _make_folder(spark, topic["path"])               # a file stream needs its folder to exist
        read_options = {"recursiveFileLookup": "true"} | read_options
    matched = matched_topic(read_lines(spark, topic["format"], topic.get("path"), read_options, stream=True))
    done = apply_completion(matched, MEASURES[cfg.get("measure", "video_length")], cfg.get("state_ttl_ms"))
    sink, result = cfg["result_sink"], result_json(done)
    if "result" in shown:
        running.append(_printed_sink(result, sink, ckpt, cfg, name))
    else:
        running.append(write_stream(result, sink["format"], ckpt, sink.get("path"), sink.get("options"),
                                    trigger=_trigger(cfg), query_name=f"{name} completion"))
    return Queries(*running)


def _rows_writer(spec: dict):
    """An epoch writer for rows: text and kafka sinks get them as JSON records."""
    write = epoch_writer(spec)
    if spec["format"] not in ("text", "kafka"):
        return write
    return lambda df, epoch_id: write(to_json_value(df), epoch_id)


def _matched_writer(spec: dict):
    """Matched sessions as JSON records; in a kafka topic keyed by (user, video), so that
    the sessions of a key stay in order. An epoch's files are written once: a retried
    epoch finds them and leaves them (same offsets and state, so the same sessions)."""
    write, key = epoch_writer(spec), [F.to_json(F.struct("userCode", "videoId")).alias("key")]

    def run(df: DataFrame, epoch_id: int) -> None:
        if spec.get("path") and _written(df.sparkSession, f"{spec['path'].rstrip('/')}/epoch={epoch_id}"):
            return                                       # its files may be planned by the reader
        value = F.to_json(F.struct(*df.columns)).alias("value")
        write(df.select(*(key if spec["format"] == "kafka" else []), value), epoch_id)
    return run


def _printed_sink(result: DataFrame, sink: dict, ckpt: str, cfg: dict, name: str):
    """The result sink with a printed copy of each epoch: one query, one state."""
    write = epoch_writer(sink)

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            print_rows(rows, f"result {epoch_id}")
            write(rows, epoch_id)
        finally:
            rows.unpersist()
    return (result.writeStream.foreachBatch(run).option("checkpointLocation", ckpt)
            .trigger(**_trigger(cfg)).queryName(f"{name} completion").start())


def _written(spark: SparkSession, folder: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def _make_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def start_tail(spark: SparkSession, cfg: dict):
    src = cfg["source"]
    opts = dict(src.get("options", {}))
    if src.get("path"):
        opts["path"] = src["path"]
    return tail_topic(spark, src["format"], opts, _checkpoint(spark, cfg, "tail"),
                      cfg.get("sink", "print"), trigger=cfg.get("trigger"), path=cfg.get("path"))


class _Done:
    """Stand-in query handle for the batch replay (already finished)."""

    def awaitTermination(self, timeout=None):
        return True


def run_replay(spark: SparkSession, cfg: dict):
    """Copy a line file to a sink in one Spark job."""
    src, sink = cfg["source"], cfg["sink"]
    replay_lines(spark, src["path"], sink["format"], sink.get("path"), sink.get("options"))
    return _Done()


JOBS = {"job1": start_job1, "job2": start_job2, "tail": start_tail, "replay": run_replay}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="watchtally.jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--config", required=True, help="JSON file with sources and sinks")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    with open(a.config) as f:
        cfg = json.load(f)
    spark = build_spark(a.master) if a.master else SparkSession.builder.getOrCreate()
    apply_defaults(spark)
    JOBS[a.job](spark, cfg).awaitTermination()


if __name__ == "__main__":
    main()

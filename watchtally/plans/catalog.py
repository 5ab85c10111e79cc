"""Registered queries: one per SURVEY §2 inventory id, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables through the fixture views
(``watchtally.sources.fixtures``) and runs the library operators on them.
The matching DuckDB SQL lives in ``watchtally.plans.oracle`` under the same
names, with the same output column names.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtally import functions as wf
from watchtally.operators import completion, enrich, rules, sessions, sinks
from watchtally.plans import composites as P
from watchtally.plans import sql
from watchtally.plans.composites import Inputs
from watchtally.session import apply_defaults, shared_dir
from watchtally.sources import fixtures
from watchtally.sources.dims import read_dim
from watchtally.sources.logs import bad_dwd, drop_null_lines, good_dwd, parse_topic, read_dwd, read_lines
from watchtally.streaming.flows import completion_stream, session_stream
from watchtally.streaming.runner import (
    run_available_now, state_partitions, write_json_lines, write_time_slices,
)

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        _REGISTRY[name] = wrapped
        return wrapped
    return deco


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# micro-batches that a replayed topic is met in
SLICES = 3
# longer than the time between two micro-batches, so that no session is cut between them
IDLE_DELAY_MS = 15_000


def _inputs(spark, d) -> Inputs:
    return Inputs.from_fixtures(spark, d)


# --- 2.1 sources and sinks ---------------------------------------------------

@query("raw_log_not_null")
def raw_log_not_null(spark, d):
    """What the line source keeps of raw lines with null payloads."""
    return drop_null_lines(fixtures.raw_log(spark, d), keep=("event_id",))


@query("replay_topic")
def replay_topic(spark, d):
    """Raw lines in a file, replayed to a topic (files) as one job, read back."""
    base = shared_dir(spark, "replay")
    lines = drop_null_lines(fixtures.raw_log(spark, d))
    sinks.write_batch(lines, "text", f"{base}/lines", mode="overwrite")
    sinks.replay_lines(spark, f"{base}/lines", "text", f"{base}/topic")
    return read_lines(spark, "text", f"{base}/topic")


@query("string_sink")
def string_sink(spark, d):
    """Result lines written as plain strings, read back."""
    topic = shared_dir(spark, "string_sink") + "/topic"
    sinks.write_batch(sinks.result_json(P.completion_once(_inputs(spark, d))), "text", topic)
    return read_lines(spark, "text", topic)


def _dim(name):
    def q(spark, d):
        path = shared_dir(spark, name) + "/table"
        fixtures.dims(spark, d)[name].write.parquet(path)
        return read_dim(spark, name, "parquet", path)
    q.__doc__ = f"S4: dimension {name} stored and read with its declared schema."
    return q


for _qn, _dn in [("dim_doctor", "doctor_info"), ("dim_video", "video_info"),
                 ("dim_rule", "credit_rule_config"), ("dim_task", "credit_task")]:
    query(_qn)(_dim(_dn))


@query("dwd_roundtrip")
def dwd_roundtrip(spark, d):
    """S5 -> S2/P11: enriched rows published as JSON topic records (a line-file
    topic in the shared folder), read back by the topic source, strictly parsed."""
    wide = P.dwd_video_wide(_inputs(spark, d), carry=False)
    topic = shared_dir(spark, "dwd_roundtrip") + "/topic"
    sinks.write_batch(sinks.to_json_value(wide), "text", topic, mode="overwrite")
    return read_dwd(spark, "text", topic, strict=True)


@query("dwd_rejects")
def dwd_rejects(spark, d):
    """A topic with planted lines (two records on a line, text behind one, an
    array, a bracket that closes early) read whole: records and rejects, none lost."""
    wide = P.dwd_video_wide(_inputs(spark, d))
    record = F.concat(F.lit('{"userCode":"'), "userCode", F.lit('","ts":'), F.col("ts").cast("string"), F.lit("}"))
    tails = ["", '{"userCode":"second"}', " tail", None, "] x"]
    kind = F.col("event_id") % 10
    line = F.concat(F.lit("["), record, F.lit("]"))
    for k, tail in enumerate(tails):
        if tail is not None:
            line = F.when(kind == k, F.concat(record, F.lit(tail))).otherwise(line)
    topic = shared_dir(spark, "dwd_rejects") + "/topic"
    sinks.write_batch(wide.select(F.when(kind >= len(tails), record).otherwise(line).alias("value")), "text", topic)
    parsed = parse_topic(read_lines(spark, "text", topic))
    good = good_dwd(parsed).select(F.lit(False).alias("rejected"), "userCode", "ts", F.lit(None).cast("string").alias("value"))
    return good.unionByName(bad_dwd(parsed).withColumn("rejected", F.lit(True)), allowMissingColumns=True)


@query("upsert_latest")
def upsert_latest(spark, d):
    """Latest session per (userCode, videoId) as key/value JSON."""
    s = P.session_metrics(_inputs(spark, d))
    return sinks.upsert_latest(s, ["userCode", "videoId"], "s0")


@query("stored_flags")
def stored_flags(spark, d):
    """completion flags kept as text (a JSON state store) and read back."""
    state = completion.completion_state(P.rule_match(_inputs(spark, d), by_key=True))
    path = shared_dir(spark, "stored_flags") + "/state"
    key = ["userCode", "videoId", "taskCode"]
    text = F.struct(*key, F.col("complete").cast("string").alias("complete"))
    sinks.write_batch(state.select(F.to_json(text).alias("value")), "text", path)
    fields = [F.get_json_object("value", f"$.{k}").alias(k) for k in (*key, "complete")]
    back = read_lines(spark, "text", path).select(*fields)
    return back.select(*key, F.col("complete").alias("flagText"),
                       wf.parse_bool("complete").alias("complete"))


@query("session_quarantine")
def session_quarantine(spark, d):
    """Q5: sessions whose video length is unusable."""
    s = P.session_quarantine(_inputs(spark, d))
    return s.select("userCode", "level", "videoId", "logCount", "videoLength", "s0")


@query("threshold_quarantine")
def threshold_quarantine(spark, d):
    """Q10: matches whose thresholds are unusable."""
    m = completion.threshold_quarantine(P.rule_match(_inputs(spark, d)))
    return m.select("userCode", "videoId", "taskCode", "s0", "ruleLength", "rulePercent")


@query("dwd_video_wide_sql")
def dwd_video_wide_sql(spark, d):
    """Job 1's enrichment as Spark SQL over named views."""
    return sql.enriched_by_sql(spark, _inputs(spark, d))


@query("rule_match_sql")
def rule_match_sql(spark, d):
    """Job 2's rule match as Spark SQL over named views."""
    return sql.matched_by_sql(spark, _inputs(spark, d))


@query("completion_state")
def completion_state(spark, d):
    """Stored state of every (user, video, task) key."""
    return completion.completion_state(P.rule_match(_inputs(spark, d), by_key=True))


# --- 2.2 projections, filters, conversions --------------------------------------

@query("clean_log")
def clean_log(spark, d):
    """Parsed, typed, renamed log rows."""
    return P.clean_log(_inputs(spark, d))


@query("dirty_log")
def dirty_log(spark, d):
    """Raw text of every dirty line."""
    return P.dirty_log(_inputs(spark, d))


@query("classify_event")
def classify_event(spark, d):
    """Event code -> event type."""
    return P.clean_log(_inputs(spark, d)).select("event_id", "eventCode", "eventType")


@query("nested_resource")
def nested_resource(spark, d):
    """Item.resource_id."""
    return P.clean_log(_inputs(spark, d)).select("event_id", "resourceId")


@query("proctime_column")
def proctime_column(spark, d):
    """Processing-time column is set on every row."""
    log = enrich.with_proctime(P.clean_log(_inputs(spark, d)))
    return log.select("event_id", F.col("pt").isNotNull().alias("has_pt"))


@query("filter_video")
def filter_video(spark, d):
    """Video events only."""
    return enrich.filter_video(P.clean_log(_inputs(spark, d)))


@query("result_json")
def result_json(spark, d):
    """Result records as JSON text."""
    return sinks.result_json(P.completion_once(_inputs(spark, d)))


@query("typed_getters")
def typed_getters(spark, d):
    """Typed getters over the JSON topic records (missing -> null / 0)."""
    wide = P.dwd_video_wide(_inputs(spark, d), carry=False)
    # numbers sent as text, decimal too, read like numbers
    wide = wide.withColumns({"tsText": F.concat(F.col("ts").cast("string"), F.lit(".9")),
                             "lengthText": F.col("video_length").cast("string")})
    v = sinks.to_json_value(wide).select(F.try_parse_json("value").alias("j"))
    return v.select(
        wf.get_string("j", "userCode").alias("userCode"),
        wf.get_long("j", "ts").alias("ts"),
        wf.get_int_value("j", "level").alias("level"),
        wf.get_int_value("j", "video_length").alias("video_length"),
        wf.get_long("j", "missing").alias("missing_long"),
        wf.get_long_value("j", "missing").alias("missing_long_value"),
        wf.get_double_value("j", "video_length").alias("length_double"),
        wf.get_long("j", "tsText").alias("text_long"),
        wf.get_int_value("j", "lengthText").alias("text_int"),
    )


@query("threshold_check")
def threshold_check(spark, d):
    """Does a single session reach its task thresholds."""
    m = P.rule_match(_inputs(spark, d))
    return m.select("userCode", "videoId", "taskCode", "s0",
                    rules.threshold_check("videoLength", "videoPercent", "ruleLength",
                                          "rulePercent").alias("passes"))


# --- 2.3 joins -----------------------------------------------------------------

@query("lookup_doctor")
def lookup_doctor(spark, d):
    """+ level (inner)."""
    i = _inputs(spark, d)
    return enrich.lookup_doctor(P.clean_log(i), i.doctor)


@query("lookup_video")
def lookup_video(spark, d):
    """Video events + video length (inner)."""
    i = _inputs(spark, d)
    return enrich.lookup_video(enrich.filter_video(P.clean_log(i)), i.video)


@query("dwd_video_wide")
def dwd_video_wide(spark, d):
    """Job 1 composite: S1 -> P1/P2 -> P3 -> J1 -> J2 -> P8."""
    return P.dwd_video_wide(_inputs(spark, d))


@query("rule_by_level")
def rule_by_level(spark, d):
    """Sessions x rules of their level."""
    i = _inputs(spark, d)
    s = P.session_metrics(i)
    return rules.rule_by_level(s, i.rule).select("userCode", "videoId", "s0", "level",
                                                 "ruleCode")


@query("task_by_rule")
def task_by_rule(spark, d):
    """(session, rule) x tasks of the rule."""
    i = _inputs(spark, d)
    s = P.session_metrics(i)
    m = rules.task_by_rule(rules.rule_by_level(s, i.rule), i.task)
    return m.select("userCode", "videoId", "s0", "ruleCode", "taskCode", "ruleLength",
                    "rulePercent")


@query("rule_table")
def rule_table(spark, d):
    """Rule x task with thresholds as JSON text."""
    i = _inputs(spark, d)
    return rules.rule_table_text(i.rule, i.task)


@query("rule_match")
def rule_match(spark, d):
    """Composite: session_metrics -> J3 -> J4 -> F1."""
    return P.rule_match(_inputs(spark, d))


# --- 2.4 aggregations / 2.7 session windows -----------------------------------

@query("session_windows")
def session_windows(spark, d):
    """Spark ``session_window`` aggregation (the streaming operator) in batch."""
    i = _inputs(spark, d)
    raw = sessions.stream_raw_sessions(P.dwd_video_wide(i, carry=False), i.gap_ms)
    return raw.select("userCode", F.col("resourceId").alias("videoId"),
                      F.col("t0").alias("s0"),
                      F.unix_millis(F.col("sw.end")).alias("s1"),
                      F.col("n").cast("bigint").alias("logCount"))


@query("session_count")
def session_count(spark, d):
    """A1: events per session (skew-proof batch sessionization)."""
    s = P.session_metrics(_inputs(spark, d))
    return s.select("userCode", "videoId", "s0", "logCount")


@query("session_metrics")
def session_metrics(spark, d):
    """A2/A4/T4: duration, length and progress per session."""
    return P.session_metrics(_inputs(spark, d))


@query("session_first_value")
def session_first_value(spark, d):
    """A3: level and video length of the session's earliest event."""
    s = P.session_metrics(_inputs(spark, d))
    return s.select("userCode", "videoId", "s0", "level", "videoLength")


@query("running_progress")
def running_progress(spark, d):
    """Running totals per key up to its completion."""
    return completion.running_progress(P.rule_match(_inputs(spark, d), by_key=True))


@query("completion_once")
def completion_once(spark, d):
    """Flagship T7 + P12 columns: each completion exactly once."""
    return P.completion_once(_inputs(spark, d))


@query("completion_first")
def completion_first(spark, d):
    """Keys complete on their first session."""
    return completion.completion_first(P.rule_match(_inputs(spark, d), by_key=True))


@query("event_time")
def event_time(spark, d):
    """Event time from the epoch-ms field (missing -> 0)."""
    wide = P.dwd_video_wide(_inputs(spark, d))
    et = sessions.event_time(wide)
    return et.select("event_id", "ts",
                     F.date_format("et", "yyyy-MM-dd HH:mm:ss.SSS").alias("et_text"))


# --- 2.6 scalar functions -------------------------------------------------------

@query("json_thresholds")
def json_thresholds(spark, d):
    """typed thresholds from task_detail."""
    return rules.task_thresholds(_inputs(spark, d).task)


@query("state_key")
def state_key(spark, d):
    """the text key of every (user, video, task) state."""
    st = completion.completion_state(P.rule_match(_inputs(spark, d), by_key=True))
    return st.select("userCode", "videoId", "taskCode",
                     wf.state_key("userCode", "videoId", "taskCode").alias("stateKey"))


@query("fmt_datetime")
def fmt_datetime(spark, d):
    """epoch ms -> 'yyyy-MM-dd HH:mm:ss:SSS' (UTC)."""
    log = P.clean_log(_inputs(spark, d))
    return log.select("event_id", "ts", wf.fmt_datetime("ts").alias("text"))


@query("fmt_date")
def fmt_date(spark, d):
    """F8: epoch ms -> 'yyyy-MM-dd' (UTC)."""
    log = P.clean_log(_inputs(spark, d))
    return log.select("event_id", "ts", wf.fmt_date("ts").alias("text"))


@query("ts_from_text")
def ts_from_text(spark, d):
    """text at +08:00 -> epoch ms (round trip of the log's ts)."""
    log = P.clean_log(_inputs(spark, d))
    text = wf.fmt_datetime("ts", "+08:00")
    return log.select("event_id", "ts", text.alias("text"),
                      wf.ts_from_text(text).alias("parsed"))


@query("ts_from_date")
def ts_from_date(spark, d):
    """date text at +08:00 -> epoch ms of its midnight."""
    log = P.clean_log(_inputs(spark, d))
    text = wf.fmt_date("ts", "+08:00")
    return log.select("event_id", text.alias("text"), wf.ts_from_date(text).alias("parsed"))


# --- streaming ------------------------------------------------------------------

def _dwd_stream(spark, i: Inputs, name: str):
    """Publish the enriched rows as a JSON topic replay and read it as a stream, one
    time slice (of many files) per micro-batch."""
    path = shared_dir(spark, name) + "/topic"
    return _read_slices(spark, path, write_time_slices(P.dwd_video_wide(i, carry=False), path, SLICES))


def _read_slices(spark, path: str, files: int):
    return read_dwd(spark, "text", path, stream=True, options={"maxFilesPerTrigger": str(files)})


@query("stream_sessions")
def stream_sessions(spark, d):
    """T2/T3/T5 streaming: sessions closed by the watermark (availableNow run)."""
    i = _inputs(spark, d)
    src = _dwd_stream(spark, i, "stream_sessions")
    return run_available_now(session_stream(src, i.gap_ms), "stream_sessions", spark,
                             partitions=state_partitions(spark))


@query("stream_completion")
def stream_completion(spark, d):
    """T7 streaming: session window -> rule join -> keyed state, emit once."""
    i = _inputs(spark, d)
    src = _dwd_stream(spark, i, "stream_completion")
    out = run_available_now(completion_stream(src, i.rule, i.task, i.gap_ms),
                            "stream_completion", spark, partitions=state_partitions(spark))
    return out.select("userCode", "taskCode", "eventType", "videoId")


@query("stream_upsert_latest")
def stream_upsert_latest(spark, d):
    """S6 streaming: closed sessions published as upserts over several micro-batches, the
    later half of them first, so that older rows come after newer ones; what a
    compacted topic keeps in the end (the last record of every key)."""
    i = _inputs(spark, d)
    base = shared_dir(spark, "stream_upsert")
    P.session_metrics(i).write.parquet(f"{base}/sessions")
    rows = spark.read.parquet(f"{base}/sessions")
    mid = rows.agg(F.expr("(min(s0) + max(s0)) div 2")).first()[0]
    for n, part in enumerate((rows.where(F.col("s0") >= mid), rows.where(F.col("s0") < mid))):
        part.write.parquet(f"{base}/topic/h{n}")         # one half per run, same checkpoint
        source = (spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true")
                  .parquet(f"{base}/topic"))

        def publish(df, epoch):
            df.write.mode("overwrite").parquet(f"{base}/compacted/epoch={epoch}")

        q = sinks.upsert_stream(source, ["userCode", "videoId"], "s0", f"{base}/checkpoint", publish,
                                {"availableNow": True})
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    records = spark.read.schema("key string, value string, epoch bigint").parquet(f"{base}/compacted")
    return records.groupBy("key").agg(F.max_by("value", "epoch").alias("value"))


@query("job2_outputs")
def job2_outputs(spark, d):
    """Job 2 as it runs (T2/T3 -> J3/J4 as of now -> T7) with all its outputs: results,
    sessions without a usable length (Q5), matches without usable thresholds (Q10) and
    rejected lines (P11) of one topic replay."""
    from watchtally.jobs import start_job2
    i = _inputs(spark, d)
    base = shared_dir(spark, "job2_outputs")
    i.rule.write.parquet(f"{base}/dims/rule")
    i.task.write.parquet(f"{base}/dims/task")
    files = write_time_slices(P.dwd_video_wide(i, carry=False), f"{base}/topic", SLICES)
    sink = lambda name: {"format": "text", "path": f"{base}/{name}"}
    start_job2(spark, {
        "name": base.rsplit("/", 1)[-1], "checkpoint": f"{base}/checkpoint", "gap_ms": i.gap_ms,
        "source": {"format": "text", "path": f"{base}/topic", "options": {"maxFilesPerTrigger": str(files)}},
        "credit_rule_config": {"path": f"{base}/dims/rule"}, "credit_task": {"path": f"{base}/dims/task"},
        "trigger": {"availableNow": True}, "result_sink": sink("result"), "reject_sink": sink("rejects"),
        "session_quarantine_sink": sink("sessions"), "threshold_quarantine_sink": sink("matches"),
    }).awaitTermination()
    names = {"result": "result", "sessions": "session_quarantine", "matches": "threshold_quarantine", "rejects": "reject"}
    out = [spark.read.schema("value string").option("recursiveFileLookup", "true").text(f"{base}/{k}")
           .select(F.lit(v).alias("output"), *(F.get_json_object("value", f"$.{c}").alias(c) for c in ("userCode", "videoId", "taskCode")),
                   F.get_json_object("value", "$.s0").cast("bigint").alias("s0")) for k, v in names.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("late_drop")
def late_drop(spark, d):
    """T5: deliver the later half of the events first, then the earlier half.

    A row is late once its window ended before the watermark of the batch
    *before* the current one (Spark's rule for chained stateful operators).
    The first run takes the later half and ends with a no-data batch that
    moves the watermark to its last event; the second run of the same
    checkpoint takes the earlier half, all of which is then behind it and
    dropped. The output is exactly the closed sessions of the later half.
    """
    i = _inputs(spark, d)
    base = shared_dir(spark, "late_drop")
    P.dwd_video_wide(i, carry=False).write.parquet(f"{base}/wide")   # parsed and joined once
    wide = spark.read.parquet(f"{base}/wide")
    mid = wide.agg(F.expr("(min(ts) + max(ts)) div 2")).first()[0]
    halves = [wide.where(F.col("ts") >= mid), wide.where(F.col("ts") < mid)]
    out = query = None
    for n, part in enumerate(halves):   # one half per run, same checkpoint
        write_json_lines(part, f"{base}/topic/h{n}", order_col="ts")
        if query is None:
            src = read_dwd(spark, "text", f"{base}/topic", stream=True,
                           options={"recursiveFileLookup": "true"})
            query = session_stream(src, i.gap_ms)
        out = run_available_now(query, "late_drop", spark, base=base,
                                partitions=state_partitions(spark))
    return out


@query("idle_flush")
def idle_flush(spark, d):
    """Sessions closed by the gap, by the watermark (any user's later event) or, where
    no later event ever arrives, by a wall-clock idle timer.

    The topic arrives in several micro-batches, with sessions that cross them.
    Every session is emitted exactly once; which of the three closed it depends on
    timing, so the output leaves that out. The run ends once a trigger has run
    later than the idle delay after the last input, when every timer is due.
    """
    from watchtally.streaming.idle import idle_flush_sessions, run_until_idle
    i = _inputs(spark, d)
    base = shared_dir(spark, "idle_flush")
    files = write_time_slices(P.dwd_video_wide(i, carry=False), f"{base}/topic", SLICES)
    out = idle_flush_sessions(_read_slices(spark, f"{base}/topic", files), i.gap_ms,
                              delay_ms=IDLE_DELAY_MS, watermark_delay="0 seconds").select(
        "userCode", F.col("resourceId").alias("videoId"), F.col("n").alias("logCount"),
        F.col("t0").alias("s0"), (F.col("t1") + F.lit(i.gap_ms)).alias("s1"),
        "level", F.col("video_length").alias("videoLength"))
    return run_until_idle(out, spark, base, IDLE_DELAY_MS, state_partitions(spark))


@query("stream_dwd_video_wide")
def stream_dwd_video_wide(spark, d):
    """Job 1 streaming: raw lines -> foreachBatch (one parse per micro-batch,
    TTL-cached dimensions, dirty and enriched sinks written per epoch) ->
    the published topic, read back."""
    from watchtally.jobs import epoch_writer
    from watchtally.sources.dims import DimensionCache
    from watchtally.streaming.flows import job1_batch_writer
    i = _inputs(spark, d)
    base = shared_dir(spark, "stream_dwd_video_wide")
    sinks.write_batch(i.raw.where(F.col("value").isNotNull()).select("value"), "text",
                      f"{base}/raw", mode="overwrite")
    body = job1_batch_writer(DimensionCache(lambda: i.doctor, partition_by=["user_id"]),
                             DimensionCache(lambda: i.video),
                             epoch_writer({"format": "text", "path": f"{base}/topic"}),
                             epoch_writer({"format": "text", "path": f"{base}/dirty"}))
    src = read_lines(spark, "text", f"{base}/raw", stream=True,
                     options={"maxFilesPerTrigger": "2"})
    q = (src.writeStream.foreachBatch(body).option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start())
    try:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()
    return read_dwd(spark, "text", f"{base}/topic", strict=True)

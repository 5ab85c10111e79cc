"""Structured Streaming: golden stream, stream = batch, restart, late rows,
idle flush, job-1 foreachBatch with TTL dimensions."""

import json
import os
import time

from pyspark.sql import functions as F

from tests import golden
from tests.conftest import SF_SMALL
from watchtally.operators import sinks
from watchtally.plans import composites as P
from watchtally.plans.composites import Inputs
from watchtally.session import shared_dir
from watchtally.sources.dims import DimensionCache
from watchtally.sources.logs import read_dwd, read_lines
from watchtally.streaming.idle import _fold, idle_flush_sessions, run_until_idle
from watchtally.streaming.flows import completion_stream, job1_batch_writer, session_stream
from watchtally.streaming.runner import stream_stats

_MTIME = [1_700_000_000]


def put_file(folder, name, lines):
    """Test replay helper: one small file with a strictly increasing mtime."""
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    _MTIME[0] += 10
    os.utime(p, (_MTIME[0], _MTIME[0]))


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def run(df, base, fmt="parquet", trigger=None, name=None):
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out"))
    q = w.trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination(300)
    return q


def golden_dwd_lines(spark):
    i = golden.inputs(spark)
    wide = P.dwd_video_wide(i, carry=False).orderBy("ts", "resourceId")
    return [r.value for r in sinks.to_json_value(wide).collect()]


def test_golden_stream(spark):
    base = shared_dir(spark, "t_golden")
    topic = local(base) + "/topic"
    for k, line in enumerate(golden_dwd_lines(spark)):
        put_file(topic, f"f{k:03d}.json", [line])
    src = read_dwd(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
    _, _, rule, task = golden.dims(spark)
    s = run(session_stream(src, 11_000), base + "/s")
    sess = sorted((r.videoId, r.logCount) for r in spark.read.parquet(f"{base}/s/out").collect())
    assert sess == [("alpha", 5), ("beta", 2), ("gamma", 2)]    # the last beta session is open
    assert stream_stats(s)["numRowsDroppedByWatermark"] == 0
    src = read_dwd(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
    run(completion_stream(src, rule, task, 11_000), base + "/c")
    got = sorted((r.videoId, r.taskCode) for r in spark.read.parquet(f"{base}/c/out").collect())
    assert got == [("alpha", "long")]                          # beta needs its last session


def _fixture_slices(spark, n):
    i = Inputs.from_fixtures(spark, SF_SMALL)
    wide = P.dwd_video_wide(i, carry=False)
    rows = sorted(((r.ts, r.value) for r in
                   sinks.to_json_value(wide).select(
                       F.get_json_object("value", "$.ts").cast("long").alias("ts"),
                       "value").collect()))
    step = -(-len(rows) // n)
    return i, [[v for _, v in rows[k:k + step]] for k in range(0, len(rows), step)]


def test_stream_equals_batch_on_closed_sessions(spark):
    i, slices = _fixture_slices(spark, 6)
    base = shared_dir(spark, "t_eq")
    topic = local(base) + "/topic"
    for k, sl in enumerate(slices):
        put_file(topic, f"s{k:03d}.json", sl)
    src = read_dwd(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
    run(completion_stream(src, i.rule, i.task, i.gap_ms), base)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/out")
                 .select("userCode", "videoId", "taskCode").collect())
    import __spark_entry__ as E
    from tools.check_oracle import duck
    sql = E.oracle_sql()["stream_completion"]
    exp = sorted((u, v, t) for u, t, _, v in duck(SF_SMALL).sql(sql).fetchall())
    assert got == exp and len(got) > 0


def test_restart_from_checkpoint(spark):
    i, slices = _fixture_slices(spark, 6)
    base = shared_dir(spark, "t_restart")
    topic = local(base) + "/topic"
    for k, sl in enumerate(slices[:3]):
        put_file(topic, f"s{k:03d}.json", sl)

    def go():
        src = read_dwd(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
        run(completion_stream(src, i.rule, i.task, i.gap_ms), base)

    go()
    first = spark.read.parquet(f"{base}/out").count()
    for k, sl in enumerate(slices[3:], start=3):
        put_file(topic, f"s{k:03d}.json", sl)
    go()                                                  # resumes offsets and keyed state
    out = spark.read.parquet(f"{base}/out")
    keys = out.select("userCode", "videoId", "taskCode")
    assert keys.count() == keys.distinct().count()        # each completion exactly once
    one = shared_dir(spark, "t_once")
    topic2 = local(one) + "/topic"
    for k, sl in enumerate(slices):
        put_file(topic2, f"s{k:03d}.json", sl)
    src = read_dwd(spark, "text", topic2, options={"maxFilesPerTrigger": "1"}, stream=True)
    run(completion_stream(src, i.rule, i.task, i.gap_ms), one)
    assert sorted(map(tuple, keys.collect())) == sorted(
        map(tuple, spark.read.parquet(f"{one}/out").select("userCode", "videoId", "taskCode")
            .collect()))
    assert 0 < first <= out.count()


def test_late_rows_dropped(spark):
    base = shared_dir(spark, "t_late")
    topic = local(base) + "/topic"
    row = {"deviceId": "d", "userCode": "u", "eventCode": "002", "resourceId": "v",
           "level": 1, "video_length": 1000}
    put_file(topic, "a.json", [json.dumps({**row, "ts": 100_000})])
    put_file(topic, "b.json", [json.dumps({**row, "ts": 89_500})])    # its window is open
    put_file(topic, "c.json", [json.dumps({**row, "ts": 80_000})])    # expired: dropped
    src = read_dwd(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
    q = run(session_stream(src, 11_000), base)
    assert stream_stats(q)["numRowsDroppedByWatermark"] == 1


def test_idle_flush(spark):
    base = shared_dir(spark, "t_idle")
    topic = local(base) + "/topic"
    row = {"deviceId": "d", "userCode": "u", "eventCode": "002", "resourceId": "v",
           "level": 1, "video_length": 1000}
    put_file(topic, "a.json", [json.dumps({**row, "ts": t}) for t in (0, 5000, 30_000)])
    src = read_dwd(spark, "text", topic, stream=True)
    q = (idle_flush_sessions(src, 11_000, 1000).writeStream.format("memory")
         .queryName("idle_t").outputMode("append")
         .option("checkpointLocation", f"{base}/ckpt")
         .trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            if spark.table("idle_t").where("closed_by = 'idle'").count() >= 1:
                break
            time.sleep(1)
    finally:
        q.stop()
    got = sorted((r.n, r.t0, r.closed_by) for r in spark.table("idle_t").collect())
    assert got == [(1, 30_000, "idle"), (2, 0, "gap")]


def test_idle_flush_across_micro_batches(spark):
    """A session that crosses micro-batches is one; rows after an idle close are late."""
    base = shared_dir(spark, "t_idle2")
    topic = local(base) + "/topic"
    row = {"deviceId": "d", "userCode": "u", "eventCode": "002", "resourceId": "v",
           "level": 1, "video_length": 1000}
    for k, ts in enumerate((5000, 0, 10_000)):            # 5 s apart, out of order
        put_file(topic, f"{k}.json", [json.dumps({**row, "ts": ts})])
    src = read_dwd(spark, "text", topic, stream=True, options={"maxFilesPerTrigger": "1"})
    out = run_until_idle(idle_flush_sessions(src, 11_000, 8000), spark, base, 8000)
    assert [(r.n, r.t0, r.t1) for r in out.collect()] == [(3, 0, 10_000)]
    put_file(topic, "late.json", [json.dumps({**row, "ts": 12_000}), json.dumps({**row, "ts": 40_000})])
    out = run_until_idle(idle_flush_sessions(src, 11_000, 2000), spark, base, 2000)
    assert sorted((r.n, r.t0) for r in out.collect()) == [(1, 40_000), (3, 0)]


def _wait(spark, q, table, n, seconds=90):
    end = time.time() + seconds
    while time.time() < end and spark.table(table).count() < n:
        if q.exception():
            raise q.exception()
        time.sleep(0.5)
    return sorted((r.userCode, r.n, r.t0, r.closed_by) for r in spark.table(table).collect())


def test_idle_flush_with_both_legs(spark):
    """Another user's progress closes a session, and so does idleness; rows behind the watermark are late."""
    base = shared_dir(spark, "t_legs")
    topic = local(base) + "/topic"

    def put(name, *events):
        put_file(topic, name, [json.dumps({"deviceId": "d", "userCode": u, "eventCode": "002", "resourceId": "v", "level": 1,
                                           "video_length": 1000, "ts": ts}) for u, ts in events])

    def start(delay_ms, table):
        src = read_dwd(spark, "text", topic, stream=True, options={"maxFilesPerTrigger": "1"})
        return (idle_flush_sessions(src, 11_000, delay_ms, "0 seconds", 500).writeStream.format("memory").queryName(table)
                .outputMode("append").option("checkpointLocation", f"{base}/{table}").trigger(processingTime="1 second").start())

    put("a.json", ("u", 5000), ("u", 0))
    q = start(600_000, "legs_t")                           # ten minutes: only the watermark closes
    try:
        put("b.json", ("other", 100_000))
        assert _wait(spark, q, "legs_t", 1) == [("u", 2, 0, "watermark")]
        put("c.json", ("u", 15_000), ("u", 50_000), ("u", 95_000), ("other", 120_000))
        put("d.json", ("third", 900_000))
        assert _wait(spark, q, "legs_t", 4) == [("other", 1, 100_000, "gap"), ("other", 1, 120_000, "watermark"),
                                                ("u", 1, 95_000, "watermark"), ("u", 2, 0, "watermark")]
    finally:
        q.stop()
    q = start(2000, "legs_idle_t")                         # two seconds: the last session is idle
    try:
        rows = _wait(spark, q, "legs_idle_t", 5)
        assert ("third", 1, 900_000, "idle") in rows and sum(n for _, n, _, _ in rows) == 6
    finally:
        q.stop()


def test_time_slices(spark):
    """A replay is many files in time order, in whatever order they are listed; a slice is one micro-batch."""
    from watchtally.streaming.runner import write_time_slices
    base = shared_dir(spark, "t_slices")
    rows = spark.range(4000).selectExpr("cast(pmod(id * 7919, 4000) as bigint) AS ts", "'u' AS userCode")
    per_slice = write_time_slices(rows, f"{base}/topic", 3)
    assert per_slice == spark.sparkContext.defaultParallelism > 1
    files = [f for f in os.listdir(local(base) + "/topic") if f.startswith("part-")]
    assert len(files) == 3 * per_slice
    stamped = sorted(files, key=lambda f: os.path.getmtime(f"{local(base)}/topic/{f}"))
    times = [[json.loads(x)["ts"] for x in open(f"{local(base)}/topic/{f}")] for f in stamped]
    assert [t for file in times for t in file] == list(range(4000)) and all(times)
    src = read_dwd(spark, "text", f"{base}/topic", stream=True, options={"maxFilesPerTrigger": str(per_slice)})
    q = run(src.select("ts"), base + "/q")
    got = [p.numInputRows for p in q.recentProgress if p.numInputRows]
    assert len(got) == 3 and sum(got) == 4000
    write_time_slices(rows.where("false"), f"{base}/none", 3)
    assert spark.read.text(f"{base}/none").count() == 0


def test_upsert_stream_respects_order(spark):
    """An older row in a later micro-batch leaves the sink at the newest one."""
    base = shared_dir(spark, "t_upsert")
    topic = local(base) + "/topic"
    for k, rows in enumerate(([("a", 10, "new"), ("b", 1, "b1")], [("a", 5, "old")], [("b", 2, "b2"), ("a", 7, "old2")], [("a", 11, "newest")])):
        put_file(topic, f"{k}.json", [json.dumps({"id": i, "at": at, "text": t}) for i, at, t in rows])
    src = spark.readStream.schema("id string, at bigint, text string").option("maxFilesPerTrigger", 1).json(topic)
    kept, seen = {}, []

    def publish(df, epoch):
        for r in df.collect():
            kept[r.key] = json.loads(r.value)["text"]
        seen.append((epoch, dict(kept)))

    def go():
        sinks.upsert_stream(src, ["id"], "at", f"{base}/ckpt", publish, {"availableNow": True}).awaitTermination(300)

    go()
    by_epoch = dict(seen)
    assert by_epoch[0] == {'{"id":"a"}': "new", '{"id":"b"}': "b1"} and by_epoch[1]['{"id":"a"}'] == "new"
    assert by_epoch[2] == {'{"id":"a"}': "new", '{"id":"b"}': "b2"} and kept['{"id":"a"}'] == "newest"
    put_file(topic, "9.json", [json.dumps({"id": "a", "at": 8, "text": "older"})])     # after a restart
    go()
    assert kept == {'{"id":"a"}': "newest", '{"id":"b"}': "b2"}


def test_repeated_delivery_is_counted_once(spark):
    """T7 behind a topic: sessions that come again after a failure change nothing."""
    from watchtally.streaming.completion import apply_completion
    from watchtally.streaming.flows import MATCHED_SCHEMA
    base = shared_dir(spark, "t_again")
    topic = local(base) + "/topic"
    tasks = [{"taskCode": c, "ruleCode": "r", "ruleLength": need, "rulePercent": 0.1} for c, need in (("t20", 20_000), ("t30", 30_000), ("t5", 5000))]
    session = lambda s0: json.dumps({"userCode": "u", "videoId": "v", "level": 1, "videoLength": 10_000, "videoPercent": 0.5, "s0": s0,
                                     "tasks": tasks + [{"taskCode": "bad", "ruleCode": "r", "rulePercent": 0.1}]})
    for k, starts in enumerate(([0], [0], [100, 0], [100])):
        put_file(topic, f"{k}.json", [session(s) for s in starts])
    src = spark.readStream.schema(MATCHED_SCHEMA).option("maxFilesPerTrigger", 1).json(topic)
    run(apply_completion(src), base)
    got = sorted((r.taskCode, r.s0) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [("t20", 100), ("t5", 0)]                # 20 s of two sessions, never 30


def test_sessions_fold_like_brute_force():
    import random
    rng = random.Random(1)
    for _ in range(300):
        ts = [rng.randrange(200) for _ in range(rng.randrange(1, 30))]
        runs, starts = [], []
        for t in ts:
            _fold(runs, starts, [1, t, t, 1, 1], 7)
        want = []
        for t in sorted(ts):
            if want and t - want[-1][2] <= 7:
                want[-1] = [want[-1][0] + 1, want[-1][1], t]
            else:
                want.append([1, t, t])
        assert [r[:3] for r in runs] == want


def test_dimension_cache_ttl(spark):
    now = [0.0]
    calls = []

    def loader():
        calls.append(1)
        return spark.range(3)

    c = DimensionCache(loader, ttl_seconds=10, clock=lambda: now[0])
    c.get(); c.get()
    now[0] = 9.9; c.get()
    assert c.loads == 1
    now[0] = 10.0; c.get()
    assert c.loads == 2 and len(calls) == 2


def test_job1_foreach_batch(spark):
    base = shared_dir(spark, "t_job1")
    topic = local(base) + "/raw"
    i = Inputs.from_fixtures(spark, SF_SMALL)
    lines = [r.value for r in i.raw.where(F.col("value").isNotNull()).collect()]
    put_file(topic, "a.txt", lines[: len(lines) // 2])
    put_file(topic, "b.txt", lines[len(lines) // 2:])
    doctor = DimensionCache(lambda: i.doctor, ttl_seconds=3600)
    video = DimensionCache(lambda: i.video, ttl_seconds=3600)

    def to(path):
        return lambda df, epoch: df.write.mode("append").text(f"{base}/{path}")

    fn = job1_batch_writer(doctor, video, to("wide"), to("dirty"))
    src = read_lines(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
    q = (src.writeStream.foreachBatch(fn).option("checkpointLocation", f"{base}/ckpt")
            .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert doctor.loads == 1
    wide = read_dwd(spark, "text", f"{base}/wide")
    batch = P.dwd_video_wide(i, carry=False)
    assert wide.count() == batch.count()
    assert wide.exceptAll(batch).count() == 0
    assert spark.read.text(f"{base}/dirty").count() == P.dirty_log(i).count()


def test_watermark_delay_keeps_late_rows(spark):
    """T2 option: with a delay, a row behind the max event time is still taken."""
    base = shared_dir(spark, "t_delay")
    topic = local(base) + "/topic"
    row = {"deviceId": "d", "userCode": "u", "eventCode": "002", "resourceId": "v",
           "level": 1, "video_length": 1000}
    put_file(topic, "a.json", [json.dumps({**row, "ts": 100_000})])
    put_file(topic, "b.json", [json.dumps({**row, "ts": 150_000})])
    put_file(topic, "c.json", [json.dumps({**row, "ts": 80_000})])   # 70 s behind the max
    src = read_dwd(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
    q = run(session_stream(src, 11_000, watermark_delay="2 minutes"), base)
    assert stream_stats(q)["numRowsDroppedByWatermark"] == 0


def test_completion_with_state_ttl(spark):
    """Q16 option: a state TTL (processing time) leaves results of a short run unchanged.

    TTL needs the processing-time mode, which keeps triggering, so the query
    runs on a processing-time trigger and is stopped once its output is in."""
    base = shared_dir(spark, "t_ttl")
    topic = local(base) + "/topic"
    for k, line in enumerate(golden_dwd_lines(spark)):
        put_file(topic, f"f{k:03d}.json", [line])
    src = read_dwd(spark, "text", topic, stream=True)
    _, _, rule, task = golden.dims(spark)
    q = (completion_stream(src, rule, task, 11_000, state_ttl_ms=3_600_000)
         .writeStream.format("memory").queryName("ttl_t").outputMode("append")
         .option("checkpointLocation", f"{base}/ckpt")
         .trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 120
        while time.time() < deadline and spark.table("ttl_t").count() < 1:
            time.sleep(1)
    finally:
        q.stop()
    got = sorted((r.videoId, r.taskCode) for r in spark.table("ttl_t").collect())
    assert got == [("alpha", "long")]


class _Handle:
    """A state handle in memory that counts accesses, each of them a round trip to the JVM."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], []

    def getValueState(self, name, schema, ttl_ms=None):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = tuple(value)

    def clear(self):
        self.calls.append("clear")
        self.value = None

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.append(at)


class _Times:
    def __init__(self, now, watermark=0):
        self.getCurrentProcessingTimeInMs = lambda: now
        self.getCurrentWatermarkInMs = lambda: watermark


def test_completion_reads_and_writes_its_state_once():
    """one read and one write of the state for a key, however many tasks it has."""
    from watchtally.streaming.completion import CompletionProcessor
    h = _Handle()
    p = CompletionProcessor(1000)
    p.init(h)
    session = lambda s0: {"s0": s0, "measure": 10, "videoPercent": 0.5, "tasks": [
        {"taskCode": f"t{need}", "ruleLength": need, "rulePercent": 0.1} for need in (5, 20, 30, 40, 50)]}
    key = ({"userCode": "u", "videoId": "v"},)
    got = [[(r.taskCode, r.s0) for r in p.handleInputRows(key, [session(s0)], _Times(now))]
           for s0, now in ((0, 0), (100, 999), (100, 999), (200, 1500), (300, 2400))]
    # t5 completes once; its time to live ends at 1000 and t20's at 1999, then they are counted anew (as before)
    assert got == [[("t5", 0)], [("t20", 100)], [], [("t5", 200), ("t30", 200)], [("t40", 300)]]
    assert h.calls == ["get", "update", "get", "update", "get", "get", "update", "get", "update"]


def test_idle_sessions_of_a_user_share_a_call():
    """a user's videos are one state value, which lets go of what the watermark makes late anyway."""
    from watchtally.streaming.idle import IdleFlushProcessor
    h = _Handle()
    p = IdleFlushProcessor(10, 1000, by_watermark=True, check_ms=100)
    p.init(h)
    row = lambda v, ts: {"resourceId": v, "ts": ts, "level": 1, "video_length": 5}
    out = lambda rows: sorted((r.resourceId, r.n, r.t0, r.closed_by) for r in rows)
    rows = [row(f"v{k}", ts) for k in range(50) for ts in (100, 105, 130)]
    assert out(p.handleInputRows(("u",), rows, _Times(0))) == sorted((f"v{k}", 2, 100, "gap") for k in range(50))
    assert h.calls == ["get", "timer", "update"] and h.timers == [100]
    assert out(p.handleInputRows(("u",), [row("v0", 112), row("v0", 139)], _Times(500))) == []  # 112 is late
    # v0 was seen at 500; the others are idle at 1000
    assert out(p.handleExpiredTimer(("u",), _Times(1000), None)) == sorted((f"v{k}", 1, 130, "idle") for k in range(1, 50))
    assert h.timers == [100, 1100] and h.value is not None
    assert out(p.handleExpiredTimer(("u",), _Times(1100, 149), None)) == [("v0", 2, 130, "watermark")]
    assert len(h.value[0]) > 50                            # 130 + two gaps: rows to 140 are still late by the state
    assert out(p.handleInputRows(("u",), [row("v1", 138)], _Times(1200, 147))) == []
    assert out(p.handleInputRows(("u",), [row("v1", 200)], _Times(1300, 160))) == []
    assert h.value[0].count("v") == 1                      # only v1's open session stays

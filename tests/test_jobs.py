"""Job 1 -> topic -> job 2 through the runnable entry points, on files."""

import json

from tests import golden
from tests.test_streaming import local, put_file
from watchtally import jobs
from watchtally.session import shared_dir


def test_job1_then_job2_end_to_end(spark):
    base = shared_dir(spark, "t_jobs")
    root = local(base)
    put_file(f"{root}/raw", "a.txt", golden.lines()[:5] + ["not json", "{}"])
    put_file(f"{root}/raw", "b.txt", golden.lines()[5:])
    doctor, video, rule, task = golden.dims(spark)
    for name, df in [("doctor", doctor), ("video", video), ("rule", rule), ("task", task)]:
        df.write.parquet(f"{base}/dims/{name}")
    once = {"availableNow": True}
    q1 = jobs.start_job1(spark, {
        "source": {"format": "text", "path": f"{root}/raw",
                   "options": {"maxFilesPerTrigger": "1"}},
        "doctor_info": {"path": f"{base}/dims/doctor"},
        "video_info": {"path": f"{base}/dims/video"},
        "wide_sink": {"format": "text", "path": f"{base}/topic"},
        "dirty_sink": {"format": "text", "path": f"{base}/dirty"},
        "trigger": once, "name": "job1_t", "print": ["dirty"]})
    q1.awaitTermination(300)
    dirty = sorted(r.value for r in spark.read.text(f"{base}/dirty").collect())
    assert dirty == ["not json", "{}"]
    wide = spark.read.text(f"{base}/topic")
    assert wide.count() == 11
    assert json.loads(wide.first().value)["video_length"] in (12000, 5000, 2000)

    q2 = jobs.start_job2(spark, {
        "source": {"format": "text", "path": f"{root}/topic",
                   "options": {"recursiveFileLookup": "true"}},
        "credit_rule_config": {"path": f"{base}/dims/rule"},
        "credit_task": {"path": f"{base}/dims/task"},
        "gap_ms": 11_000,
        "result_sink": {"format": "json", "path": f"{base}/result"},
        "trigger": once, "name": "job2_t", "print": ["sessions", "result"],
        "session_quarantine_sink": {"format": "json", "path": f"{base}/bad_sessions"},
        "threshold_quarantine_sink": {"format": "json", "path": f"{base}/bad_matches"}})
    q2.awaitTermination(300)
    got = sorted(json.loads(r.value)["taskCode"] + "@" + json.loads(r.value)["videoId"]
                 for r in spark.read.json(f"{base}/result").collect())
    # both epochs' topic files arrive as one batch here: every session but the last
    # of beta closes
    assert got == ["long@alpha"]


def test_replay_job(spark, tmpdir_run):
    src = f"{tmpdir_run}/sample.json"
    with open(src, "w") as f:
        f.write("\n".join(golden.lines()) + "\n")
    cfg = f"{tmpdir_run}/replay.json"
    with open(cfg, "w") as f:
        json.dump({"source": {"path": src},
                   "sink": {"format": "text", "path": f"{tmpdir_run}/topic"}}, f)
    jobs.JOBS["replay"](spark, json.load(open(cfg))).awaitTermination()
    assert spark.read.text(f"{tmpdir_run}/topic").count() == 11


def test_epoch_writer_is_idempotent(spark, tmpdir_run):
    """A retried micro-batch (same epoch id) replaces its own output."""
    write = jobs.epoch_writer({"format": "text", "path": f"{tmpdir_run}/sink"})
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    write(df, 3)
    write(df, 3)                       # retry of epoch 3
    write(df.limit(1), 4)
    assert spark.read.text(f"{tmpdir_run}/sink").count() == 3


def test_read_dim_formats(spark, tmpdir_run):
    """Dimensions from parquet or CSV come back with the declared schema."""
    from watchtally.sources.dims import DIMENSIONS, read_dim
    doctor, video, _, task = golden.dims(spark)
    video.write.parquet(f"{tmpdir_run}/video")
    task.write.options(header="true", quote='"', escape='"').csv(f"{tmpdir_run}/task")
    v = read_dim(spark, "video_info", "parquet", f"{tmpdir_run}/video")
    t = read_dim(spark, "credit_task", "csv", f"{tmpdir_run}/task",
                 {"header": "true", "quote": '"', "escape": '"'})
    assert v.schema == DIMENSIONS["video_info"] and v.count() == 3
    assert t.schema == DIMENSIONS["credit_task"]
    assert sorted(r.task_detail for r in t.collect()) == sorted(r.task_detail for r in task.collect())


def test_cli_main_replay(spark, tmpdir_run):
    src = f"{tmpdir_run}/in.txt"
    with open(src, "w") as f:
        f.write("a\nb\n")
    cfg = f"{tmpdir_run}/cfg.json"
    with open(cfg, "w") as f:
        json.dump({"source": {"path": src}, "sink": {"format": "text", "path": f"{tmpdir_run}/o"}}, f)
    jobs.main(["replay", "--config", cfg])
    assert sorted(r.value for r in spark.read.text(f"{tmpdir_run}/o").collect()) == ["a", "b"]


def test_dimension_cache_partitioning(spark):
    from watchtally.sources.dims import DimensionCache
    doctor, _, _, _ = golden.dims(spark)
    c = DimensionCache(lambda: doctor, 3600, partition_by=["user_id"])
    plan = c.get()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan
    assert c.get().count() == 1


def _job2_cfg(base, **more):
    return {"source": {"format": "text", "path": f"{base}/topic"},
            "credit_rule_config": {"path": f"{base}/dims/rule"},
            "credit_task": {"path": f"{base}/dims/task"}, "gap_ms": 11_000,
            "result_sink": {"format": "json", "path": f"{base}/result"},
            "trigger": {"availableNow": True}, **more}


def _event(user, video, second, length=12000):
    return json.dumps({"deviceId": "d", "userCode": user, "eventCode": "002", "resourceId": video,
                       "ts": golden.T + 1000 * second, "level": 3, "video_length": length})


def test_restart_with_default_checkpoint(spark):
    """Both jobs continue after a second start with default settings: each result once."""
    base = shared_dir(spark, "t_restart_jobs")
    root = local(base)
    name = base.rsplit("-", 1)[-1]
    for k, df in zip(("doctor", "video", "rule", "task"), golden.dims(spark)):
        df.write.parquet(f"{base}/dims/{k}")
    cfg = {"source": {"format": "text", "path": f"{root}/raw"},
           "doctor_info": {"path": f"{base}/dims/doctor"},
           "video_info": {"path": f"{base}/dims/video"},
           "wide_sink": {"format": "text", "path": f"{base}/wide"},
           "dirty_sink": {"format": "text", "path": f"{base}/dirty"},
           "trigger": {"availableNow": True}, "name": f"job1-{name}"}
    for k, part in enumerate((golden.lines()[:6], golden.lines()[6:] + ["{} {}"])):
        put_file(f"{root}/raw", f"{k}.txt", part)
        jobs.start_job1(spark, cfg).awaitTermination(300)
    assert spark.read.option("recursiveFileLookup", "true").text(f"{base}/wide").count() == 11
    assert spark.read.option("recursiveFileLookup", "true").text(f"{base}/dirty").count() == 1

    cfg = _job2_cfg(root, name=f"job2-{name}")
    watch = lambda user, at: [_event(user, "alpha", at + 4 * k) for k in range(5)]
    put_file(f"{root}/topic", "a.json", watch("u1", 0) + [_event("u1", "other", 500)])
    jobs.start_job2(spark, cfg).awaitTermination(300)
    put_file(f"{root}/topic", "b.json", watch("u2", 520) + [_event("u2", "other", 900)])
    jobs.start_job2(spark, cfg).awaitTermination(300)
    got = sorted(json.loads(r.value)["userCode"] for r in spark.read.json(f"{base}/result").collect()
                 if json.loads(r.value)["videoId"] == "alpha")
    assert got == ["u1", "u2"]


def test_new_task_is_seen_without_a_restart(spark):
    """A task added while the job runs counts within the TTL, in the same queries; the job's name has blanks."""
    import time
    base = shared_dir(spark, "t_refresh")
    root = local(base)
    _, _, rule, task = golden.dims(spark)
    rule.write.parquet(f"{base}/dims/rule")
    task.where("code = 'half'").write.parquet(f"{base}/dims/task")
    cfg = _job2_cfg(root, name="my job " + base.rsplit("-", 1)[-1], trigger={"processingTime": "1 second"}, dim_ttl_seconds=1)
    put_file(f"{root}/topic", "a.json", [_event("u1", "alpha", 4 * k) for k in range(5)] + [_event("u1", "z", 100)])
    job = jobs.start_job2(spark, cfg)
    ids = [q.id for q in job.queries]

    def matched(user):
        for _ in range(120):
            assert not job.awaitTermination(1)
            rows = spark.read.schema("value string").option("recursiveFileLookup", "true").text(f"{job_topic}")
            if rows.where(f"value like '%{user}%alpha%'").count():
                return
        raise AssertionError("not matched")

    from watchtally.session import job_folder
    job_topic = job_folder(spark, cfg["name"]) + "/checkpoint-matched"
    try:
        matched("u1")
        task.where("code = 'long'").write.mode("append").parquet(f"{base}/dims/task")
        time.sleep(1.5)
        put_file(f"{root}/topic", "b.json", [_event("u2", "alpha", 120 + 4 * k) for k in range(5)] + [_event("u2", "z", 300)])
        matched("u2")
        for _ in range(120):
            assert not job.awaitTermination(1)
            rows = spark.read.schema("value string").json(f"{base}/result").collect()
            if rows:
                break
        assert [q.id for q in job.queries] == ids and job.isActive
    finally:
        job.stop()
    got = [json.loads(r.value) for r in rows]
    assert [(r["userCode"], r["taskCode"], r["videoId"]) for r in got] == [("u2", "long", "alpha")]


def test_a_failing_query_ends_the_job(spark):
    """No query of a job dies unnoticed: its error is raised and the others are stopped."""
    import pytest
    base = shared_dir(spark, "t_fail")
    root = local(base)
    _, _, rule, task = golden.dims(spark)
    rule.write.parquet(f"{base}/dims/rule")
    task.write.parquet(f"{base}/dims/task")
    put_file(f"{root}/topic", "a.json", [_event("u1", "alpha", 0), "not a record"])
    with pytest.raises(Exception, match="not a topic record"):
        jobs.start_job2(spark, _job2_cfg(root, name="job2-" + base.rsplit("-", 1)[-1])).awaitTermination(300)
    job = jobs.start_job2(spark, _job2_cfg(root, name="job2b-" + base.rsplit("-", 1)[-1], trigger={"processingTime": "1 second"}))
    with pytest.raises(Exception, match="not a topic record"):
        job.awaitTermination(300)
    assert not job.isActive
    with pytest.raises(ValueError):
        jobs.start_job2(spark, _job2_cfg(root, print=["everything"]))


def test_reject_sink(spark):
    """With a reject sink bad topic lines go there, whole, and the records count."""
    base = shared_dir(spark, "t_reject")
    root = local(base)
    _, _, rule, task = golden.dims(spark)
    rule.write.parquet(f"{base}/dims/rule")
    task.write.parquet(f"{base}/dims/task")
    bad = ["not a record", _event("u9", "alpha", 0) + _event("u9", "alpha", 4), "[1]"]
    put_file(f"{root}/topic", "a.json", [_event("u1", "alpha", 4 * k) for k in range(5)] + bad + [_event("u1", "z", 500)])
    jobs.start_job2(spark, _job2_cfg(root, name="job2-" + base.rsplit("-", 1)[-1],
                                     reject_sink={"format": "text", "path": f"{base}/rejects"})).awaitTermination(300)
    assert sorted(r.value for r in spark.read.text(f"{base}/rejects").collect()) == sorted(bad)
    got = [json.loads(r.value) for r in spark.read.json(f"{base}/result").collect()]
    assert {(r["userCode"], r["videoId"]) for r in got} == {("u1", "alpha")}


def test_retried_epoch_leaves_its_matched_sessions(spark, tmpdir_run):
    """The files of an epoch that the completion query may have planned are not replaced."""
    write = jobs._matched_writer({"format": "text", "path": f"{tmpdir_run}/matched"})
    df = spark.createDataFrame([("u", "v", 1)], "userCode string, videoId string, s0 long")
    write(df, 0)
    files = lambda: [r.path for r in spark.read.format("binaryFile").load(f"{tmpdir_run}/matched/epoch=0").select("path").collect()]
    before = files()
    write(df, 0)
    write(df, 1)
    assert files() == before and spark.read.text(f"{tmpdir_run}/matched").count() == 2


def test_job2_with_idle_close(spark):
    """T6 in job 2: nobody sends later events, and the session's result still comes."""
    base = shared_dir(spark, "t_job2_idle")
    root = local(base)
    _, _, rule, task = golden.dims(spark)
    rule.write.parquet(f"{base}/dims/rule")
    task.write.parquet(f"{base}/dims/task")
    put_file(f"{root}/topic", "a.json", [_event("u1", "alpha", 4 * k) for k in range(5)])
    cfg = _job2_cfg(root, name="job2-" + base.rsplit("-", 1)[-1], trigger={"processingTime": "1 second"}, idle_delay_ms=2000)
    job = jobs.start_job2(spark, cfg)
    rows = []
    try:
        for _ in range(120):
            assert not job.awaitTermination(1)
            rows = spark.read.schema("value string").json(f"{base}/result").collect()
            if rows:
                break
    finally:
        job.stop()
    assert [json.loads(r.value)["taskCode"] for r in rows] == ["long"]


def test_quarantine_sinks(spark):
    """Main output and quarantine together hold every closed session and match."""
    base = shared_dir(spark, "t_quarantine")
    root = local(base)
    _, _, rule, task = golden.dims(spark)
    rule.write.parquet(f"{base}/dims/rule")
    task.union(spark.createDataFrame([("bad", "basic", "not json")], task.schema)).write.parquet(f"{base}/dims/task")
    rows = [_event("u1", "alpha", 0), _event("u1", "flat", 1, 0), _event("u1", "none", 2, None), _event("u1", "end", 500)]
    put_file(f"{root}/topic", "a.json", rows)
    sink = lambda k: {"format": "json", "path": f"{base}/{k}"}
    q = jobs.start_job2(spark, _job2_cfg(root, name="job2-" + base.rsplit("-", 1)[-1],
                                         session_quarantine_sink=sink("sessions"), threshold_quarantine_sink=sink("matches")))
    assert q.awaitTermination(300) and len(q.queries) == 2     # one session state for all outputs
    assert sorted(r.videoId for r in spark.read.json(f"{base}/sessions").collect()) == ["flat", "none"]
    assert [(r.videoId, r.taskCode) for r in spark.read.json(f"{base}/matches").collect()] == [("alpha", "bad")]


def test_unknown_print_labels(spark):
    import pytest
    from watchtally.streaming.flows import job1_batch_writer
    with pytest.raises(ValueError):
        job1_batch_writer(None, None, None, None, show=("everything",))


def test_tail_prints_every_line_whole(tmpdir_run):
    """50 long lines come out complete (a run of its own, to read what it prints)."""
    import os
    import subprocess
    import sys
    from tests.conftest import ROOT
    lines = [f"{k:02d} " + "x" * 300 for k in range(50)]
    put_file(f"{tmpdir_run}/topic", "a.txt", lines)
    with open(f"{tmpdir_run}/cfg.json", "w") as f:
        json.dump({"source": {"format": "text", "path": f"{tmpdir_run}/topic"}, "trigger": {"availableNow": True},
                   "checkpoint": f"{tmpdir_run}/ckpt"}, f)
    run = subprocess.run([sys.executable, "-m", "watchtally.jobs", "tail", "--config", f"{tmpdir_run}/cfg.json", "--master", "local[2]"],
                         cwd=ROOT, env=os.environ | {"WT_DRIVER_MEMORY": "1g"}, capture_output=True, text=True, timeout=240)
    assert run.returncode == 0, run.stderr[-2000:]
    assert sorted(x for x in (run.stdout + run.stderr).splitlines() if x[:2].isdigit() and x[3:4] == "x") == lines

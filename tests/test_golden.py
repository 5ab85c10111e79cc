"""FIXTURES.md §3: the small invented log, end to end in batch."""

from tests import golden
from watchtally.operators import completion, sinks
from watchtally.plans import composites as P


def test_clean_and_wide(spark):
    i = golden.inputs(spark)
    assert P.dirty_log(i).count() == 0
    log = P.clean_log(i).collect()
    assert len(log) == 11
    assert {r.eventType for r in log} == {"video"}
    wide = P.dwd_video_wide(i).collect()
    assert len(wide) == 11
    assert {(r.resourceId, r.video_length) for r in wide} == {
        ("alpha", 12000), ("beta", 5000), ("gamma", 2000)}


def test_sessions(spark):
    i = golden.inputs(spark)
    got = sorted((r.videoId, r.logCount, r.duration, r.videoLength, r.videoPercent, r.level)
                 for r in P.session_metrics(i).collect())
    assert got == sorted([
        ("alpha", 5, 5000, 12000, 0.42, 3),
        ("beta", 2, 2000, 5000, 0.40, 3),
        ("beta", 2, 2000, 5000, 0.40, 3),
        ("gamma", 2, 2000, 2000, 1.00, 3),
    ])


def test_completions(spark):
    i = golden.inputs(spark)
    got = sorted((r.videoId, r.taskCode) for r in P.completion_once(i).collect())
    assert got == [("alpha", "long"), ("beta", "half"), ("beta", "long")]


def test_state(spark):
    i = golden.inputs(spark)
    st = {(r.videoId, r.taskCode): r for r in
          completion.completion_state(P.rule_match(i)).collect()}
    assert st[("alpha", "half")].complete is False
    assert st[("alpha", "half")].videoLength == 12000
    assert abs(st[("beta", "long")].videoPercent - 0.8) < 1e-12
    assert st[("beta", "long")].videoLength == 10000
    assert st[("beta", "half")].complete is True
    assert st[("gamma", "long")].complete is False
    assert st[("alpha", "long")].ruleLength == 10000


def test_result_json_order(spark):
    i = golden.inputs(spark)
    vals = sorted(r.value for r in sinks.result_json(P.completion_once(i)).collect())
    assert vals[0] == '{"userCode":"kim","taskCode":"half","eventType":"video","videoId":"beta"}'


def test_duration_measure(spark):
    # Q2 option: accumulate watched duration instead of the video's length
    i = golden.inputs(spark)
    got = sorted((r.videoId, r.taskCode) for r in
                 completion.completion_once(P.rule_match(i), measure="duration").collect())
    assert got == [("beta", "half")]     # 2 s + 2 s reach 4 s; nothing reaches 10 s


def test_null_thresholds_quarantined(spark):
    i = golden.inputs(spark)
    i.task = spark.createDataFrame([
        ("long", "basic", '{"watchVideoLengthOfTime":10000,"watchVideoWatchLengthOfTimePercentage":0.4}'),
        ("T9", "basic", '{"watchVideoWatchLengthOfTimePercentage":0.1}'),    # no length
        ("T8", "basic", "not json"),
    ], "code string, rule_code string, task_detail string")
    m = P.rule_match(i)
    done = sorted((r.videoId, r.taskCode) for r in completion.completion_once(m).collect())
    assert done == [("alpha", "long"), ("beta", "long")]
    q = completion.threshold_quarantine(m)
    assert sorted({r.taskCode for r in q.collect()}) == ["T8", "T9"]
    assert q.count() == 8                              # 4 sessions x 2 bad tasks


def test_replay_and_upsert(spark, tmpdir_run):
    src = f"{tmpdir_run}/sample.json"
    with open(src, "w") as f:
        f.write("\n".join(golden.lines()) + "\n")
    sinks.replay_lines(spark, src, "text", f"{tmpdir_run}/topic")
    assert spark.read.text(f"{tmpdir_run}/topic").count() == 11
    rows = {r.key: r.value for r in sinks.upsert_latest(P.session_metrics(golden.inputs(spark)), ["userCode", "videoId"], "s0").collect()}
    assert len(rows) == 3
    assert f'"s0":{golden.T + 300_000}' in rows['{"userCode":"kim","videoId":"beta"}']   # the later session

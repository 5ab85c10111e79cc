"""SQL view form = DataFrame form; streaming state snapshot; topic tail."""

from tests import golden
from tests.conftest import SF_SMALL
from tests.test_streaming import golden_dwd_lines, local, put_file, run
from watchtally.plans import composites as P
from watchtally.plans import sql as S
from watchtally.plans.composites import Inputs
from watchtally.session import shared_dir
from watchtally.sources.logs import read_dwd
from watchtally.streaming.flows import completion_stream
from watchtally.streaming.state import completion_state_snapshot, tail_topic


def test_sql_views_equal_dataframe_form(spark):
    i = Inputs.from_fixtures(spark, SF_SMALL)
    for by_sql, df in ((S.enriched_by_sql(spark, i), P.dwd_video_wide(i, carry=False)),
                       (S.matched_by_sql(spark, i), P.rule_match(i))):
        assert by_sql.count() == df.count() > 0
        assert by_sql.exceptAll(df.select(*by_sql.columns)).count() == 0


def test_state_snapshot(spark):
    base = shared_dir(spark, "t_state")
    topic = local(base) + "/topic"
    for k, line in enumerate(golden_dwd_lines(spark)):
        put_file(topic, f"f{k:03d}.json", [line])
    src = read_dwd(spark, "text", topic, options={"maxFilesPerTrigger": "1"}, stream=True)
    _, _, rule, task = golden.dims(spark)
    run(completion_stream(src, rule, task, 11_000), base)
    st = {(r.videoId, r.taskCode): r for r in
          completion_state_snapshot(spark, f"{base}/ckpt").collect()}
    assert st[("alpha", "long")].complete is True
    assert st[("beta", "long")].complete is False and st[("beta", "long")].videoLength == 5000
    assert st[("gamma", "half")].complete is False


def test_tail_topic(spark):
    base = shared_dir(spark, "t_tail")
    topic = local(base) + "/topic"
    put_file(topic, "a.txt", ["x", "y"])
    q = tail_topic(spark, "text", {"path": topic}, f"{base}/ckpt", sink="memory",
                   query_name="tail_t")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.value for r in spark.table("tail_t").collect()) == ["x", "y"]


def test_string_and_labelled_sinks(spark):
    """S7 plain string sink (text stands in for a topic) and S8 labelled sink."""
    from watchtally.operators.sinks import write_stream
    base = shared_dir(spark, "t_sinks")
    topic = local(base) + "/in"
    put_file(topic, "a.txt", golden.lines())
    src = spark.readStream.text(topic)
    q1 = write_stream(src, "text", f"{base}/ck1", path=f"{base}/out",
                      trigger={"availableNow": True})
    q2 = write_stream(src, "memory", f"{base}/ck2", trigger={"availableNow": True},
                      query_name="label_dwd")
    q1.awaitTermination(120)
    q2.awaitTermination(120)
    assert spark.read.text(f"{base}/out").count() == 11
    assert spark.table("label_dwd").count() == 11

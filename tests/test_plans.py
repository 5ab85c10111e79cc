"""Physical-plan properties the design relies on (read from ``explain``)."""

import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from watchtally.operators import enrich
from watchtally.plans import composites as P
from watchtally.plans.composites import Inputs


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_parse_runs_once_and_filters_stay_above_generator(spark):
    i = Inputs.from_fixtures(spark, SF_SMALL)
    i.raw = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("props").alias("value"))                 # a real source column
    i.carry = ()
    p = plan(P.dwd_video_wide(i, carry=False))
    assert p.count("parseJson") == 1, p
    gen = p.index("Generate")
    # the clean/video/isnotnull predicates sit above the generator
    above = p[:gen]
    assert "is_dirty" in above and "eventType" in above


def test_sessions_use_hash_aggregates_only(spark):
    p = plan(P.session_metrics(Inputs.from_fixtures(spark, SF_SMALL)))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p
    assert "HashAggregate" in p


def test_bounded_dimensions_broadcast_and_pushdown(spark):
    i = Inputs.from_fixtures(spark, SF_SMALL)
    p = plan(P.rule_match(i))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in formatted(P.dwd_video_wide(i))


def test_completion_windows_need_no_shuffle_of_the_joined_rows(spark):
    p = plan(P.completion_once(Inputs.from_fixtures(spark, SF_SMALL)))
    above = p[: p.index("BroadcastHashJoin")]            # the rule join is the topmost join
    assert "Window" in above and "Exchange" not in above


def test_late_join_with_repeated_keys(spark):
    """Repeated dimension rows count like an event-level join's."""
    i = Inputs.from_fixtures(spark, SF_SMALL)
    i.doctor = i.doctor.union(i.doctor.where("user_id in ('1', '2')"))
    i.video = i.video.union(i.video.where("video_id = '15'"))
    a, b = P.session_metrics(i), P.session_metrics(i, late_join=False)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 < a.where("logCount > 1").count()

def test_broadcast_bound_falls_back_to_shuffle_join(spark):
    i = Inputs.from_fixtures(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        log = P.clean_log(i)
        p = plan(enrich.lookup_video(enrich.filter_video(log), i.video, max_broadcast_rows=3))
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
        p = plan(enrich.lookup_video(enrich.filter_video(log), i.video, max_broadcast_rows=1000))
        assert "BroadcastHashJoin" in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_broadcast_bound_counts_bytes(spark):
    """A side of few but wide rows is not broadcast; what a side is reduced from is measured instead of it."""
    from watchtally.operators.broadcast import bounded_broadcast, measure
    wide = spark.createDataFrame([(k, "x" * 1000, [b"y" * 500]) for k in range(50)], "id long, text string, more array<binary>")
    rows, size = measure(wide)
    assert rows == 50 and 50 * 1500 < size < 50 * 2500
    hint = lambda df: df._jdf.queryExecution().logical().toString()
    assert "Hint broadcast" in hint(bounded_broadcast(wide, max_bytes=1 << 20))
    assert "Hint merge" in hint(bounded_broadcast(wide, max_bytes=50_000))
    assert "Hint merge" in hint(bounded_broadcast(wide.limit(1), max_bytes=50_000, source=wide))
    assert measure(spark.createDataFrame([], "id long, text string")) == (0, 0)


def test_a_side_is_measured_once_in_a_while(spark):
    from watchtally.operators import broadcast
    tracker = spark.sparkContext.statusTracker()

    def jobs(f):
        spark.sparkContext.setJobGroup("measure", "")
        before = len(tracker.getJobIdsForGroup("measure"))
        f()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup("measure")) - before

    one, other = Inputs.from_fixtures(spark, SF_SMALL), Inputs.from_fixtures(spark, SF_SMALL)
    broadcast._measured.clear()
    first = jobs(lambda: P.completion_once(one))
    assert jobs(lambda: P.completion_once(other)) == 0 < first


def test_column_pruning_reaches_scan(spark):
    i = Inputs.from_fixtures(spark, SF_SMALL)
    p = formatted(P.session_metrics(i))
    # events: value column never read; customer: only the two used columns
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint," \
           "event_type:string,props:string>" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in p


def test_parse_generator_and_joins_share_one_codegen_stage(spark):
    df = P.dwd_video_wide(Inputs.from_fixtures(spark, SF_SMALL))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    stages = {m.group(1) for line in final.splitlines()
              for m in [re.search(r"\*\((\d+)\) (Generate|BroadcastHashJoin)", line)] if m}
    assert len(stages) == 1, final

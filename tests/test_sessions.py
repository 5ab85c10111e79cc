"""Session property: the cell / bucket / stitch form equals brute-force
gaps-and-islands, for any bucket width, and equals Spark's session_window."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from watchtally.operators import sessions
from watchtally.plans import composites as P
from watchtally.plans.composites import Inputs


def brute(events, gap):
    out = []
    by_key = {}
    for u, r, ts in events:
        by_key.setdefault((u, r), []).append(ts)
    for (u, r), tss in by_key.items():
        tss.sort()
        start, last, n = tss[0], tss[0], 1
        for t in tss[1:]:
            if t - last > gap:
                out.append((u, r, n, start, last))
                start, n = t, 0
            n += 1
            last = t
        out.append((u, r, n, start, last))
    return sorted(out)


def as_df(spark, events):
    return spark.createDataFrame(
        [(u, r, ts, 1, 1000) for u, r, ts in events],
        "userCode string, resourceId string, ts bigint, level int, video_length int")


def spark_sessions(df, gap, bucket):
    raw = sessions.raw_sessions(df, gap, bucket_ms=bucket)
    return sorted((r.userCode, r.resourceId, r.n, r.t0, r.t1) for r in raw.collect())


@settings(max_examples=12, deadline=None)
@given(seed=st.integers(0, 10_000), gap=st.integers(1, 50), mult=st.integers(1, 6))
def test_random_events_match_brute_force(spark, seed, gap, mult):
    rnd = random.Random(seed)
    events = []
    for _ in range(rnd.randint(1, 120)):
        u = rnd.choice("ab")
        r = rnd.choice("xyz")
        events.append((u, r, rnd.randint(-300, 300)))    # negative times included
    # a dense burst on one hot key, crossing bucket borders
    events += [("a", "x", t) for t in range(0, 200, rnd.randint(1, gap))]
    bucket = gap * mult
    assert spark_sessions(as_df(spark, events), gap, bucket) == brute(events, gap)


def test_gap_boundary(spark):
    ev = [("u", "v", 0), ("u", "v", 11000), ("u", "v", 22001)]
    assert spark_sessions(as_df(spark, ev), 11000, None) == sorted(
        [("u", "v", 2, 0, 11000), ("u", "v", 1, 22001, 22001)])


def test_batch_forms_agree_on_test_tables(spark):
    i = Inputs.from_fixtures(spark, SF_MID)
    wide = P.dwd_video_wide(i, carry=False)
    sw = sessions.stream_raw_sessions(wide, i.gap_ms)
    ref = sorted((r.userCode, r.resourceId, r.n, r.t0, r.t1) for r in sw.collect())
    for bucket in (None, 86_400_000, 3 * 86_400_000, 10 * 86_400_000):
        assert spark_sessions(wide, i.gap_ms, bucket) == ref


def test_first_value_is_earliest_event(spark):
    df = spark.createDataFrame(
        [("u", "v", 10, 3, 500), ("u", "v", 5, 2, 400), ("u", "v", 12, 1, 300)],
        "userCode string, resourceId string, ts bigint, level int, video_length int")
    r = sessions.session_metrics(df, gap_ms=100).first()
    assert (r.level, r.videoLength, r.logCount, r.duration) == (2, 400, 3, 3000)
    assert r.videoPercent == 7.5                        # 3000*100/400 = 750 -> 7.50


def test_quarantine_invalid_length(spark):
    df = spark.createDataFrame(
        [("u", "v", 10, 1, 0), ("u", "w", 10, 1, None), ("u", "x", 10, 1, 1000)],
        "userCode string, resourceId string, ts bigint, level int, video_length int")
    assert [r.videoId for r in sessions.session_metrics(df).collect()] == ["x"]
    assert sorted(r.videoId for r in sessions.session_quarantine(df).collect()) == ["v", "w"]
    assert df.where(F.col("video_length") > 0).count() == 1


def test_late_dimension_join_equals_event_level_join(spark):
    i = Inputs.from_fixtures(spark, SF_MID)
    late = P.session_metrics(i, late_join=True)
    early = P.session_metrics(i, late_join=False)
    assert late.count() == early.count() > 0
    assert late.exceptAll(early.select(*late.columns)).count() == 0


def test_missing_level_and_length_read_as_zero(spark):
    df = spark.createDataFrame(
        [("u", "v", 10, None, 1000), ("u", "w", 10, 2, None), ("u", "x", None, 1, 500)],
        "userCode string, resourceId string, ts bigint, level int, video_length int")
    got = {r.videoId: r for r in sessions.session_metrics(df).collect()}
    assert got["v"].level == 0                      # matches level-0 rules downstream
    assert "w" not in got                           # length 0 -> quarantine
    assert got["x"].s0 == 0                         # missing ts -> event time 0
    assert [r.videoLength for r in sessions.session_quarantine(df).collect()] == [0]

"""FIXTURES.md §5 edge lines for the JSON step, and scalar-function edges."""

import pytest
from pyspark.sql import functions as F

from watchtally import functions as wf
from watchtally.operators.clean import parse_log
from watchtally.operators.rules import task_thresholds

ITEM = '"Item":{"resource_id":"7"}'
EDGES = [
    # (line, dirty?, expected ts, expected resourceId, expected eventType)
    ("not json", True, None, None, None),
    ("[1]", True, None, None, None),
    ("null", True, None, None, None),
    ("", True, None, None, None),
    ("{}", True, None, None, None),
    ('{"Item":[]}', True, None, None, None),
    ('{"Item":{}}', False, None, None, "other"),
    ('{"ts":1,' + ITEM + '}', False, 1, "7", "other"),
    ('{"ts":"12",' + ITEM + '}', False, 12, "7", "other"),
    ('{"ts":"abc",' + ITEM + '}', True, None, None, None),
    ('{' + ITEM + '}', False, None, "7", "other"),
    ('{"event":"002","ts":5,"Item":{"resource_id":"7","video_id":"x","endTime":3}}',
     False, 5, "7", "video"),
    ('{"event":"004","ts":5,"Item":{"resource_id":9}}', False, 5, "9", "other"),
    ('{"ts":"",' + ITEM + '}', False, None, "7", "other"),
    ('{"ts":"null",' + ITEM + '}', False, None, "7", "other"),
    ('{"ts":"5.9",' + ITEM + '}', False, 5, "7", "other"),
    ('{"ts":5.9,' + ITEM + '}', False, 5, "7", "other"),
    ('{"ts":{},' + ITEM + '}', True, None, None, None),
    ('{"deviceId":[1],' + ITEM + '}', False, None, "7", "other"),
    ('{"ts":1,' + ITEM + '}{"ts":2,' + ITEM + '}', True, None, None, None),
    ('{"ts":1,' + ITEM + '},{"ts":2,' + ITEM + '}', True, None, None, None),
    ('{"ts":1,' + ITEM + '} trailing', True, None, None, None),
    ('{"ts":1,"ts":2,' + ITEM + '}', False, 2, "7", "other"),
    ('1], [2', True, None, None, None),
    ('{"ts":1,' + ITEM + '}] x', True, None, None, None),
]


def test_edge_lines(spark):
    rows = [(i, v) for i, (v, *_rest) in enumerate(EDGES)]
    raw = spark.createDataFrame(rows + [(99, None)], "id int, value string")
    got = {r.id: r for r in parse_log(raw).collect()}
    assert 99 not in got                               # null payload: neither branch
    for i, (line, dirty, ts, res, etype) in enumerate(EDGES):
        r = got[i]
        assert r.is_dirty == dirty, line
        assert r.value == line
        if not dirty:
            assert r.ts == ts, line
            assert r.resourceId == res, line
            assert r.eventType == etype, line


def test_thresholds_lenient(spark):
    task = spark.createDataFrame([
        ("a", "R", '{"watchVideoLengthOfTime":9000,"watchVideoWatchLengthOfTimePercentage":0.6}'),
        ("b", "R", '{"watchVideoLengthOfTime":"10.7"}'),
        ("c", "R", "not json"),
        ("d", "R", None),
    ], "code string, rule_code string, task_detail string")
    got = {r.taskCode: (r.ruleLength, r.rulePercent) for r in task_thresholds(task).collect()}
    assert got == {"a": (9000, 0.6), "b": (None, None), "c": (None, None), "d": (None, None)}


@pytest.mark.parametrize("x,expected", [(0.005, 0.01), (0.004999, 0.0), (0.125, 0.13),
                                        (1.0, 1.0), (0.7, 0.7)])
def test_half_up(spark, x, expected):
    v = spark.range(1).select(wf.half_up(F.lit(x) * 100) / 100).first()[0]
    assert v == pytest.approx(expected)


def test_time_functions(spark):
    df = spark.createDataFrame([(1700000000123,)], "ts bigint")
    r = df.select(wf.fmt_datetime("ts").alias("a"), wf.fmt_date("ts").alias("b"),
                  wf.fmt_datetime("ts", "+08:00").alias("c"),
                  wf.ts_from_text(wf.fmt_datetime("ts", "+08:00")).alias("d"),
                  wf.ts_from_date(F.lit("2023-11-15")).alias("e"),
                  wf.ts_from_text(F.lit("garbage")).alias("f")).first()
    assert r.a == "2023-11-14 22:13:20:123"
    assert r.b == "2023-11-14"
    assert r.c == "2023-11-15 06:13:20:123"
    assert r.d == 1700000000123
    assert r.e == 1699977600000                      # 2023-11-15 00:00 at +08:00
    assert r.f is None


def test_state_key_and_bool(spark):
    df = spark.createDataFrame([("u", "v", "t", "TRUE"), ("u", None, "t", "yes")],
                               "u string, v string, t string, b string")
    got = df.select(wf.state_key("u", "v", "t").alias("k"), wf.parse_bool("b").alias("b")).collect()
    assert [(r.k, r.b) for r in got] == [("video:u:v:t", True), ("video:u:null:t", False)]


def test_getters(spark):
    df = spark.createDataFrame([('{"a":"12","b":5.9,"c":"x","d":"5.9"}',)], "s string") \
              .select(F.try_parse_json("s").alias("j"))
    r = df.select(wf.get_long("j", "a").alias("a"), wf.get_long("j", "b").alias("b"),
                  wf.get_int_value("j", "c").alias("c"), wf.get_long_value("j", "z").alias("z"),
                  wf.get_double_value("j", "a").alias("d"), wf.get_string("j", "b").alias("e"),
                  wf.get_long("j", "d").alias("f"), wf.get_int_value("j", "d").alias("g")).first()
    assert (r.a, r.b, r.c, r.z, r.d, r.e, r.f, r.g) == (12, 5, 0, 0, 12.0, "5.9", 5, 5)


def test_topic_records(spark):
    """Coerced like the log lines; strict fails on what is no object, lenient leaves it aside."""
    import pytest
    from watchtally.sources.logs import bad_dwd, parse_dwd, parse_topic
    df = spark.createDataFrame([('{"ts":"12","level":"1","userCode":7}',), ("not json",), ("[1]",)], "value string")
    rows = parse_dwd(df, strict=False).collect()
    assert [(r.ts, r.level, r.userCode, r.video_length) for r in rows] == [(12, 1, "7", None)]
    assert bad_dwd(parse_topic(df)).count() == 2
    with pytest.raises(Exception, match="not a topic record"):
        parse_dwd(df).collect()


BAD_RECORDS = ['{"userCode":"u1"}{"userCode":"u2"}', '{"userCode":"u1"} {"userCode":"u2"}', '{"userCode":"u1"},{"userCode":"u2"}',
               '{"userCode":"u1"} tail', '{"userCode":"u1"}] x', '{"userCode":"u1"}, 1', '["u"]', '"u"', "7", "null", "", "  ", "{", '{"userCode":"u1"']


def test_topic_lines_are_one_record_each(spark):
    """Two records on a line, text behind one and other values are rejects, whole; nothing is lost or half read."""
    import pytest
    from watchtally.sources.logs import bad_dwd, good_dwd, parse_dwd, parse_topic
    good = ['{"userCode":"a","ts":1}', ' {"userCode":"b"} ', "{}", '{"userCode":"x","userCode":"c"}', '{"userCode":"]","ts":"3"}']
    parsed = parse_topic(spark.createDataFrame([(x,) for x in good + BAD_RECORDS], "value string"))
    assert [r.userCode for r in good_dwd(parsed).collect()] == ["a", "b", None, "c", "]"]
    assert sorted(r.value for r in bad_dwd(parsed).collect()) == sorted(BAD_RECORDS)
    for line in BAD_RECORDS:
        with pytest.raises(Exception, match="not a topic record"):
            parse_dwd(spark.createDataFrame([(line,)], "value string")).collect()
        with pytest.raises(Exception, match="not a topic record"):
            parse_dwd(spark.createDataFrame([(line,)], "value string")).count()

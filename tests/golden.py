"""A small invented log with hand-computed results, and the dimensions it needs.

User kim watches alpha (12 s long) in one session of five events, beta (5 s) in
two sessions of two events, and gamma (2 s) in one of two; the gap is 11 s.
"""

import json

T = 1_700_000_000_000
# (video, seconds after T, event)
ROWS = [("alpha", 0, "001"), ("alpha", 4, "002"), ("alpha", 8, "002"), ("alpha", 12, "002"),
        ("alpha", 16, "003"), ("beta", 20, "001"), ("beta", 24, "003"), ("gamma", 26, "001"),
        ("gamma", 30, "003"), ("beta", 300, "001"), ("beta", 305, "003")]


def lines():
    return [json.dumps({"deviceId": "tablet", "userCode": "kim", "event": e, "ts": T + 1000 * s,
                        "Item": {"resource_id": v}}, separators=(",", ":")) for v, s, e in ROWS]


def dims(spark):
    doctor = spark.createDataFrame([("kim", 3)], "user_id string, level int")
    video = spark.createDataFrame([("alpha", 12000), ("beta", 5000), ("gamma", 2000)],
                                  "video_id string, video_length int")
    rule = spark.createDataFrame([("basic", 3)], "rule_code string, doctor_level int")
    task = spark.createDataFrame([
        ("long", "basic", '{"watchVideoLengthOfTime":10000,"watchVideoWatchLengthOfTimePercentage":0.4}'),
        ("half", "basic", '{"watchVideoLengthOfTime":4000,"watchVideoWatchLengthOfTimePercentage":0.5}'),
    ], "code string, rule_code string, task_detail string")
    return doctor, video, rule, task


def inputs(spark):
    from watchtally.plans.composites import Inputs
    raw = spark.createDataFrame([(v,) for v in lines()], "value string")
    doctor, video, rule, task = dims(spark)
    return Inputs(raw, doctor, video, rule, task, gap_ms=11_000)

"""Named views and Spark SQL over them.

Both statements read the cleaned operators' outputs under view names of their
own and give the rows of ``composites.dwd_video_wide`` and ``rule_match``;
Catalyst plans them like the DataFrame forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from watchtally.operators.rules import task_thresholds
from watchtally.plans import composites as P
from watchtally.plans.composites import Inputs


def enriched_by_sql(spark: SparkSession, i: Inputs) -> DataFrame:
    """Video events with user level and video length."""
    for name, df in {"wt_events": P.clean_log(i), "wt_users": i.doctor, "wt_videos": i.video}.items():
        df.createOrReplaceTempView(name)
    return spark.sql("""
        WITH watched AS (SELECT * FROM wt_events WHERE eventType = 'video'),
             graded AS (SELECT watched.*, wt_users.level
                        FROM watched INNER JOIN wt_users ON user_id = userCode)
        SELECT graded.deviceId, userCode, eventCode, ts, resourceId, level, video_length
        FROM graded INNER JOIN wt_videos ON video_id = resourceId""")


def matched_by_sql(spark: SparkSession, i: Inputs) -> DataFrame:
    """Sessions with the tasks of their level's rules and the tasks' thresholds."""
    views = {"wt_sessions": P.session_metrics(i), "wt_rules": i.rule,
             "wt_thresholds": task_thresholds(i.task)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql("""
        WITH goals AS (SELECT doctor_level, taskCode, r.rule_code AS ruleCode, ruleLength, rulePercent
                       FROM wt_rules r INNER JOIN wt_thresholds t ON t.rule_code = r.rule_code)
        SELECT s.*, g.taskCode, g.ruleCode, g.ruleLength, g.rulePercent
        FROM wt_sessions s INNER JOIN goals g ON g.doctor_level = s.level""")

"""Match sessions with the rules and tasks of the level.

The rule and task tables are configuration (a few rows per level), so their
pre-joined form (J5) is one small broadcast side, checked by row count first.
Duplicate (rule, level) or (task, rule) rows fan a session out several times,
exactly like the plain joins of the reference (SURVEY Q15).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchtally.functions.scalar import json_double, json_int, json_text
from watchtally.operators.broadcast import DEFAULT_MAX_ROWS, bounded_broadcast

# Fixed values that must equal the reference: the JSON paths of the two
# thresholds inside credit_task.task_detail.
LENGTH_PATH = "$.watchVideoLengthOfTime"
PERCENT_PATH = "$.watchVideoWatchLengthOfTimePercentage"


def task_thresholds(task: DataFrame) -> DataFrame:
    """typed thresholds of every task (null when absent or unusable)."""
    return task.select(
        F.col("code").alias("taskCode"),
        F.col("rule_code"),
        json_int("task_detail", LENGTH_PATH).alias("ruleLength"),
        json_double("task_detail", PERCENT_PATH).alias("rulePercent"),
    )


def rule_table(rule: DataFrame, task: DataFrame) -> DataFrame:
    """Rule x task on rule_code, thresholds typed (F1)."""
    t = task_thresholds(task)
    r = rule.select("rule_code", "doctor_level")
    return (t.join(r, "rule_code", "inner")
             .select("taskCode", F.col("rule_code").alias("ruleCode"), "doctor_level",
                     "ruleLength", "rulePercent"))


def rule_table_text(rule: DataFrame, task: DataFrame) -> DataFrame:
    """J5 as written in the reference's commented query: thresholds as text (F2)."""
    r = rule.select("rule_code", "doctor_level")
    return (task.join(r, "rule_code", "inner")
                .select(F.col("code").alias("task_code"), "rule_code", "doctor_level",
                        json_text("task_detail", LENGTH_PATH).alias("rule_length"),
                        json_text("task_detail", PERCENT_PATH).alias("rule_percent")))


def rule_by_level(sessions: DataFrame, rule: DataFrame,
                  max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Each session x every rule configured for its level."""
    r = bounded_broadcast(rule.select(F.col("rule_code").alias("ruleCode"),
                                      "doctor_level"), max_broadcast_rows)
    return (sessions.join(r, sessions["level"] == r["doctor_level"], "inner")
                    .drop("doctor_level"))


def task_by_rule(by_rule: DataFrame, task: DataFrame,
                 max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Each (session, rule) x every task of the rule, thresholds typed."""
    t = bounded_broadcast(task_thresholds(task), max_broadcast_rows)
    return (by_rule.join(t, by_rule["ruleCode"] == t["rule_code"], "inner")
                   .drop("rule_code"))


def rule_match(sessions: DataFrame, rule: DataFrame, task: DataFrame,
               max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """J3 + J4 + F1 in one broadcast join against the pre-joined rule table."""
    rt = bounded_broadcast(rule_table(rule, task), max_broadcast_rows)
    return (sessions.join(rt, sessions["level"] == rt["doctor_level"], "inner")
                    .drop("doctor_level"))


def level_tasks(rule: DataFrame, task: DataFrame) -> DataFrame:
    """J5 by level: one row a level with all its tasks and thresholds (configuration,
    so a level's list is short). Repeated rule or task rows stay repeated."""
    entry = F.struct("taskCode", "ruleCode", "ruleLength", "rulePercent")
    return (rule_table(rule, task).groupBy("doctor_level")
            .agg(F.sort_array(F.collect_list(entry)).alias("tasks")))


def match_tasks(sessions: DataFrame, rule: DataFrame, task: DataFrame,
                max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """J3 + J4 without the fan-out: each session once, with the ``tasks`` of its level."""
    return with_tasks(sessions, level_tasks(rule, task), max_broadcast_rows)


def with_tasks(sessions: DataFrame, by_level: DataFrame,
               max_broadcast_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """:func:`match_tasks` over a table of :func:`level_tasks` that is at hand."""
    lt = bounded_broadcast(by_level, max_broadcast_rows)
    return (sessions.join(lt, sessions["level"] == lt["doctor_level"], "inner")
                    .drop("doctor_level"))


def each_task(matched: DataFrame) -> DataFrame:
    """The rows of :func:`rule_match` from those of :func:`match_tasks`."""
    rest = [c for c in matched.columns if c != "tasks"]
    return matched.select(*rest, F.inline("tasks"))


def threshold_check(length, percent, rule_length, rule_percent) -> Column:
    """Both thresholds reached (null thresholds never pass)."""
    c = [F.col(x) if isinstance(x, str) else x
         for x in (length, percent, rule_length, rule_percent)]
    return F.coalesce((c[0] >= c[2]) & (c[1] >= c[3]), F.lit(False))

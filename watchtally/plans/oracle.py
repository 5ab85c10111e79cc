"""DuckDB oracle SQL for every registered query (same names, same columns).

The prefix re-derives the fixture views of FIXTURES.md §4 from the raw test
tables; sessions are computed the textbook way (``lag`` + running sum of the
break flag over raw events), independent of the Spark implementation's
cell / bucket / stitch decomposition.
"""

from __future__ import annotations

from watchtally.sources.fixtures import FIXTURE_GAP_MS

GAP = FIXTURE_GAP_MS

PREFIX = f"""
WITH log AS (
  SELECT concat('d', event_id % 7) AS deviceId,
         cast(user_id AS VARCHAR) AS userCode,
         CASE event_type WHEN 'view' THEN '001' WHEN 'click' THEN '002'
              WHEN 'purchase' THEN '003' WHEN 'signup' THEN '004' ELSE '005' END AS eventCode,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'video' ELSE 'other' END
           AS eventType,
         epoch_us(ts) // 1000 AS ts,
         cast(user_id * 14 + TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 10
              AS VARCHAR) AS resourceId,
         event_id
  FROM events),
rawlog AS (
  SELECT event_id,
         CASE event_id % 50
              WHEN 0 THEN '{{"deviceId'
              WHEN 1 THEN '{{}}'
              WHEN 2 THEN NULL
              WHEN 3 THEN concat(js, js)
              WHEN 4 THEN concat(js, ' and more')
              WHEN 5 THEN concat('{{"ts":1,"userCode":"nobody",', substring(js, 2))
              WHEN 6 THEN concat(head, event, '"ts":"', ts, '"', tail)
              WHEN 7 THEN concat(head, event, '"ts":"abc"', tail)
              WHEN 8 THEN concat(head, event, '"ts":', ts, ',"Item":[]}}')
              WHEN 9 THEN concat(head, '"ts":', ts, tail)
              WHEN 10 THEN concat(head, event, '"ts":', ts, ',"Item":{{}}}}')
              WHEN 11 THEN concat(head, event, '"ts":"', ts, '.9"', tail)
              ELSE js END AS value
  FROM (SELECT *, concat(head, event, '"ts":', ts, tail) AS js FROM (
          SELECT *, concat('{{"deviceId":"', deviceId, '","userCode":"', userCode, '",') AS head,
                 concat('"event":"', eventCode, '",') AS event,
                 concat(',"Item":{{"resource_id":"', resourceId, '"}}}}') AS tail FROM log))),
clean AS (
  SELECT deviceId, userCode, CASE WHEN event_id % 50 = 9 THEN NULL ELSE eventCode END AS eventCode,
         CASE WHEN event_id % 50 = 9 THEN 'other' ELSE eventType END AS eventType, ts,
         CASE WHEN event_id % 50 = 10 THEN NULL ELSE resourceId END AS resourceId, event_id
  FROM log WHERE event_id % 50 NOT IN (0, 1, 2, 3, 4, 7, 8)),
doctor AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN cast(c_custkey AS VARCHAR)
              ELSE concat('debt-', c_custkey) END AS user_id,
         cast(c_custkey // 2 AS INTEGER) AS level FROM customer),
video AS (
  SELECT cast(p_partkey AS VARCHAR) AS video_id,
         cast(CASE WHEN p_size = 25 THEN 0 WHEN p_size < 50 THEN p_size * 1000 END AS INTEGER)
           AS video_length
  FROM part),
rule AS (
  SELECT concat('R', s_nationkey % 5) AS rule_code, cast(s_suppkey AS INTEGER) AS doctor_level
  FROM supplier),
task AS (
  SELECT concat('T', n_nationkey) AS code, concat('R', n_regionkey) AS rule_code,
         concat('{{', CASE WHEN n_nationkey % 10 < 9 THEN
                  concat('"watchVideoLengthOfTime":', (n_nationkey % 10 + 1) * 9000, ',') END,
                '"watchVideoWatchLengthOfTimePercentage":',
                cast(0.05 * (n_nationkey % 10 + 1) AS DECIMAL(4, 2)), '}}') AS task_detail
  FROM nation),
thresholds AS (
  SELECT code AS taskCode, rule_code,
         TRY_CAST(json_extract_string(task_detail, '$.watchVideoLengthOfTime') AS INTEGER)
           AS ruleLength,
         TRY_CAST(json_extract_string(task_detail, '$.watchVideoWatchLengthOfTimePercentage')
           AS DOUBLE) AS rulePercent
  FROM task),
rtab AS (
  SELECT t.taskCode, t.rule_code AS ruleCode, r.doctor_level, t.ruleLength, t.rulePercent
  FROM thresholds t JOIN rule r ON t.rule_code = r.rule_code),
leveled AS (
  SELECT c.*, d.level FROM clean c JOIN doctor d ON c.userCode = d.user_id),
wide AS (
  SELECT l.deviceId, l.userCode, l.eventCode, l.ts, l.resourceId, l.level, v.video_length,
         l.event_id
  FROM leveled l JOIN video v ON l.resourceId = v.video_id
  WHERE l.eventType = 'video'),
ev AS (
  SELECT userCode, resourceId, coalesce(ts, 0) AS ts, coalesce(level, 0) AS level,
         coalesce(video_length, 0) AS video_length, event_id FROM wide),
flagged AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > {GAP} THEN 1 ELSE 0 END
              AS brk
  FROM ev WINDOW w AS (PARTITION BY userCode, resourceId ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(brk) OVER (PARTITION BY userCode, resourceId ORDER BY ts, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM flagged),
sess AS (
  SELECT userCode, resourceId AS videoId, count(*) AS n, min(ts) AS t0, max(ts) AS t1,
         first(level ORDER BY ts, level, video_length) AS level,
         first(video_length ORDER BY ts, level, video_length) AS videoLength
  FROM numbered GROUP BY userCode, resourceId, sid),
sessions AS (
  SELECT userCode, level, videoId, cast(n AS BIGINT) AS logCount,
         cast(n * 1000 AS BIGINT) AS duration, videoLength,
         floor(cast(n * 1000 AS DOUBLE) * 100.0 / videoLength + 0.5) / 100.0 AS videoPercent,
         cast(t0 AS BIGINT) AS s0, cast(t1 + {GAP} AS BIGINT) AS s1
  FROM sess WHERE videoLength > 0),
matched AS (
  SELECT s.*, rt.taskCode, rt.ruleCode, rt.ruleLength, rt.rulePercent
  FROM sessions s JOIN rtab rt ON s.level = rt.doctor_level),
run0 AS (
  SELECT userCode, videoId, taskCode, s0,
         cast(row_number() OVER w AS INTEGER) AS seq,
         cast(sum(videoLength) OVER wr AS BIGINT) AS videoLength,
         sum(videoPercent) OVER wr AS videoPercent,
         first_value(ruleLength) OVER wr AS ruleLength,
         first_value(rulePercent) OVER wr AS rulePercent
  FROM matched WHERE ruleLength IS NOT NULL AND rulePercent IS NOT NULL
  WINDOW w AS (PARTITION BY userCode, videoId, taskCode ORDER BY s0),
         wr AS (PARTITION BY userCode, videoId, taskCode ORDER BY s0
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
run1 AS (
  SELECT *, coalesce(videoLength >= ruleLength AND videoPercent >= rulePercent, false)
              AS complete
  FROM run0),
progress AS (
  SELECT * EXCLUDE (earlier) FROM (
    SELECT *, coalesce(sum(CASE WHEN complete THEN 1 ELSE 0 END) OVER (
                PARTITION BY userCode, videoId, taskCode ORDER BY s0
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
    FROM run1) WHERE earlier = 0),
done AS (SELECT * FROM progress WHERE complete),
state AS (
  SELECT userCode, videoId, taskCode,
         arg_max(complete, s0) AS complete, arg_max(videoLength, s0) AS videoLength,
         arg_max(videoPercent, s0) AS videoPercent, arg_max(ruleLength, s0) AS ruleLength,
         arg_max(rulePercent, s0) AS rulePercent
  FROM progress GROUP BY userCode, videoId, taskCode),
maxts AS (SELECT max(coalesce(ts, 0)) AS m FROM wide),
closed_sessions AS (SELECT * FROM sessions WHERE s1 <= (SELECT m FROM maxts)),
closed_matched AS (
  SELECT s.*, rt.taskCode, rt.ruleCode, rt.ruleLength, rt.rulePercent
  FROM closed_sessions s JOIN rtab rt ON s.level = rt.doctor_level),
crun0 AS (
  SELECT userCode, videoId, taskCode, s0,
         sum(videoLength) OVER wr AS videoLength,
         sum(videoPercent) OVER wr AS videoPercent,
         first_value(ruleLength) OVER wr AS ruleLength,
         first_value(rulePercent) OVER wr AS rulePercent
  FROM closed_matched WHERE ruleLength IS NOT NULL AND rulePercent IS NOT NULL
  WINDOW wr AS (PARTITION BY userCode, videoId, taskCode ORDER BY s0
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
crun1 AS (
  SELECT *, coalesce(videoLength >= ruleLength AND videoPercent >= rulePercent, false)
              AS complete
  FROM crun0),
cdone AS (
  SELECT * FROM (
    SELECT *, coalesce(sum(CASE WHEN complete THEN 1 ELSE 0 END) OVER (
                PARTITION BY userCode, videoId, taskCode ORDER BY s0
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
    FROM crun1) WHERE earlier = 0 AND complete)
"""

LOG_COLS = "deviceId, userCode, eventCode, eventType, ts, resourceId, event_id"
DWD_COLS = "deviceId, userCode, eventCode, ts, resourceId, level, video_length"
SESSION_COLS = "userCode, level, videoId, logCount, duration, videoLength, videoPercent, s0, s1"
RESULT_COLS = "userCode, taskCode, 'video' AS eventType, videoId"

BODIES = {
    "raw_log_not_null": "SELECT value, event_id FROM rawlog WHERE value IS NOT NULL",
    "dim_doctor": "SELECT user_id, level FROM doctor",
    "dim_video": "SELECT video_id, video_length FROM video",
    "dim_rule": "SELECT rule_code, doctor_level FROM rule",
    "dim_task": "SELECT code, rule_code, task_detail FROM task",
    "dwd_roundtrip": f"SELECT {DWD_COLS} FROM wide",
    "stream_dwd_video_wide": f"SELECT {DWD_COLS} FROM wide",
    "upsert_latest": """
        SELECT concat('{"userCode":"', userCode, '","videoId":"', videoId, '"}') AS key,
               concat('{"userCode":"', userCode, '","level":', level, ',"videoId":"', videoId,
                      '","logCount":', logCount, ',"duration":', duration,
                      ',"videoLength":', videoLength, ',"videoPercent":',
                      cast(videoPercent AS VARCHAR), ',"s0":', s0, ',"s1":', s1, '}') AS value
        FROM (SELECT *, row_number() OVER (PARTITION BY userCode, videoId ORDER BY s0 DESC) rn
              FROM sessions) WHERE rn = 1""",
    "completion_state": """SELECT userCode, videoId, taskCode, complete, videoLength,
                                  videoPercent, ruleLength, rulePercent FROM state""",
    "clean_log": f"SELECT {LOG_COLS} FROM clean",
    "dirty_log": "SELECT value, event_id FROM rawlog WHERE event_id % 50 IN (0, 1, 3, 4, 7, 8)",
    "classify_event": "SELECT event_id, eventCode, eventType FROM clean",
    "nested_resource": "SELECT event_id, resourceId FROM clean",
    "proctime_column": "SELECT event_id, true AS has_pt FROM clean",
    "filter_video": f"SELECT {LOG_COLS} FROM clean WHERE eventType = 'video'",
    "result_json": """
        SELECT concat('{"userCode":"', userCode, '","taskCode":"', taskCode,
                      '","eventType":"video","videoId":"', videoId, '"}') AS value FROM done""",
    "typed_getters": """
        SELECT userCode, ts, level, coalesce(video_length, 0) AS video_length,
               CAST(NULL AS BIGINT) AS missing_long,
               CAST(0 AS BIGINT) AS missing_long_value,
               cast(coalesce(video_length, 0) AS DOUBLE) AS length_double, ts AS text_long,
               coalesce(video_length, 0) AS text_int FROM wide""",
    "threshold_check": """
        SELECT userCode, videoId, taskCode, s0,
               coalesce(videoLength >= ruleLength AND videoPercent >= rulePercent, false)
                 AS passes FROM matched""",
    "lookup_doctor": f"SELECT {LOG_COLS}, level FROM leveled",
    "lookup_video": f"""
        SELECT c.deviceId, c.userCode, c.eventCode, c.eventType, c.ts, c.resourceId, c.event_id,
               v.video_length
        FROM clean c JOIN video v ON c.resourceId = v.video_id WHERE c.eventType = 'video'""",
    "dwd_video_wide": f"SELECT {DWD_COLS}, event_id FROM wide",
    "rule_by_level": """
        SELECT s.userCode, s.videoId, s.s0, s.level, r.rule_code AS ruleCode
        FROM sessions s JOIN rule r ON s.level = r.doctor_level""",
    "task_by_rule": """
        SELECT s.userCode, s.videoId, s.s0, r.rule_code AS ruleCode, t.taskCode, t.ruleLength,
               t.rulePercent
        FROM sessions s JOIN rule r ON s.level = r.doctor_level
        JOIN thresholds t ON t.rule_code = r.rule_code""",
    "rule_table": """
        SELECT t.code AS task_code, t.rule_code, r.doctor_level,
               json_extract_string(t.task_detail, '$.watchVideoLengthOfTime') AS rule_length,
               json_extract_string(t.task_detail, '$.watchVideoWatchLengthOfTimePercentage')
                 AS rule_percent
        FROM task t JOIN rule r ON t.rule_code = r.rule_code""",
    "rule_match": f"""SELECT {SESSION_COLS}, taskCode, ruleCode, ruleLength, rulePercent
                      FROM matched""",
    "session_windows": f"""
        SELECT userCode, videoId, cast(t0 AS BIGINT) AS s0, cast(t1 + {GAP} AS BIGINT) AS s1,
               cast(n AS BIGINT) AS logCount FROM sess""",
    "session_count": "SELECT userCode, videoId, s0, logCount FROM sessions",
    "session_metrics": f"SELECT {SESSION_COLS} FROM sessions",
    "session_first_value": "SELECT userCode, videoId, s0, level, videoLength FROM sessions",
    "running_progress": """SELECT userCode, videoId, taskCode, s0, seq, videoLength,
                                  videoPercent, ruleLength, rulePercent, complete
                           FROM progress""",
    "completion_once": f"SELECT {RESULT_COLS} FROM done",
    "completion_first": f"SELECT {RESULT_COLS} FROM done WHERE seq = 1",
    "event_time": """
        SELECT event_id, ts,
               strftime(make_timestamp(coalesce(ts, 0) * 1000), '%Y-%m-%d %H:%M:%S.%g')
                 AS et_text FROM wide""",
    "json_thresholds": "SELECT taskCode, rule_code, ruleLength, rulePercent FROM thresholds",
    "state_key": """
        SELECT userCode, videoId, taskCode,
               concat('video:', userCode, ':', videoId, ':', taskCode) AS stateKey FROM state""",
    "fmt_datetime": """
        SELECT event_id, ts, strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S:%g') AS text
        FROM clean""",
    "fmt_date": """
        SELECT event_id, ts, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS text
        FROM clean""",
    "ts_from_text": """
        SELECT event_id, ts,
               strftime(make_timestamp(ts * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S:%g')
                 AS text,
               ts AS parsed FROM clean""",
    "ts_from_date": """
        SELECT event_id, text,
               epoch_us(strptime(text, '%Y-%m-%d') - INTERVAL 8 HOUR) // 1000 AS parsed
        FROM (SELECT event_id,
                     strftime(make_timestamp(ts * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d') AS text
              FROM clean)""",
    "stream_sessions": f"SELECT {SESSION_COLS} FROM closed_sessions",
    "idle_flush": f"""
        SELECT userCode, videoId, cast(n AS BIGINT) AS logCount, cast(t0 AS BIGINT) AS s0,
               cast(t1 + {GAP} AS BIGINT) AS s1, level, videoLength FROM sess""",
    "late_drop": f"""
        , mid AS (SELECT (min(ts) + max(ts)) // 2 AS m FROM wide),
        a_ev AS (SELECT * FROM ev WHERE ts >= (SELECT m FROM mid)),
        a_flag AS (
          SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > {GAP}
                         THEN 1 ELSE 0 END AS brk
          FROM a_ev WINDOW w AS (PARTITION BY userCode, resourceId ORDER BY ts, event_id)),
        a_num AS (
          SELECT *, sum(brk) OVER (PARTITION BY userCode, resourceId ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
          FROM a_flag),
        a_sess AS (
          SELECT userCode, resourceId AS videoId, count(*) AS n, min(ts) AS t0, max(ts) AS t1,
                 first(level ORDER BY ts, level, video_length) AS level,
                 first(video_length ORDER BY ts, level, video_length) AS videoLength
          FROM a_num GROUP BY userCode, resourceId, sid)
        SELECT userCode, level, videoId, cast(n AS BIGINT) AS logCount,
               cast(n * 1000 AS BIGINT) AS duration, videoLength,
               floor(cast(n * 1000 AS DOUBLE) * 100.0 / videoLength + 0.5) / 100.0
                 AS videoPercent,
               cast(t0 AS BIGINT) AS s0, cast(t1 + {GAP} AS BIGINT) AS s1
        FROM a_sess
        WHERE videoLength > 0 AND t1 + {GAP} <= (SELECT max(ts) FROM a_ev)""",
    "session_quarantine": """
        SELECT userCode, level, videoId, cast(n AS BIGINT) AS logCount, videoLength,
               cast(t0 AS BIGINT) AS s0 FROM sess WHERE coalesce(videoLength, 0) <= 0""",
    "threshold_quarantine": f"""
        SELECT userCode, videoId, taskCode, s0, ruleLength, rulePercent FROM matched
        WHERE ruleLength IS NULL OR rulePercent IS NULL""",
    "dwd_video_wide_sql": f"SELECT {DWD_COLS} FROM wide",
    "rule_match_sql": f"""SELECT {SESSION_COLS}, taskCode, ruleCode, ruleLength, rulePercent
                          FROM matched""",
    "stored_flags": """
        SELECT userCode, videoId, taskCode, cast(complete AS VARCHAR) AS flagText, complete
        FROM state""",
    "replay_topic": "SELECT value FROM rawlog WHERE value IS NOT NULL",
    "string_sink": """
        SELECT concat('{"userCode":"', userCode, '","taskCode":"', taskCode,
                      '","eventType":"video","videoId":"', videoId, '"}') AS value FROM done""",
    "dwd_rejects": """
        , lines AS (
          SELECT *, event_id % 10 AS k, concat('{"userCode":"', userCode, '","ts":', ts, '}') AS record FROM wide)
        SELECT k BETWEEN 1 AND 4 AS rejected, CASE WHEN k NOT BETWEEN 1 AND 4 THEN userCode END AS userCode,
               CASE WHEN k NOT BETWEEN 1 AND 4 THEN ts END AS ts,
               CASE k WHEN 1 THEN concat(record, '{"userCode":"second"}') WHEN 2 THEN concat(record, ' tail')
                      WHEN 3 THEN concat('[', record, ']') WHEN 4 THEN concat(record, '] x') END AS value
        FROM lines""",
    "job2_outputs": f"""
        , closed_all AS (SELECT * FROM sess WHERE t1 + {GAP} <= (SELECT m FROM maxts))
        SELECT 'result' AS output, userCode, videoId, taskCode, cast(NULL AS BIGINT) AS s0 FROM cdone
        UNION ALL
        SELECT 'session_quarantine', userCode, videoId, NULL, cast(t0 AS BIGINT) FROM closed_all
        WHERE coalesce(videoLength, 0) <= 0
        UNION ALL
        SELECT 'threshold_quarantine', userCode, videoId, taskCode, s0 FROM closed_matched
        WHERE ruleLength IS NULL OR rulePercent IS NULL""",
    "stream_completion": f"SELECT {RESULT_COLS} FROM cdone",
}


BODIES["stream_upsert_latest"] = BODIES["upsert_latest"]


def oracle_sql() -> dict[str, str]:
    return {k: PREFIX + v for k, v in BODIES.items()}

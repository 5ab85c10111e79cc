"""A hot key holding a third of all events: exact results, bounded groups.

The skewed input is derived from the ``events`` table: every third event is
re-keyed to one (user, video) pair, and its timestamps are compressed so the
hot key is dense (many events per gap) as well as long-running.
"""

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tools.check_oracle import duck
from watchtally.operators import sessions

GAP = 60_000
BUCKET = 3_600_000


def skewed(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    ms = F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
                       .cast("timestamp"))
    ev = ev.select("event_id", "user_id", ms.alias("ms"), (F.col("event_id") % 3 == 0).alias("hot"))
    return ev.select(
        F.when(F.col("hot"), F.lit("hot")).otherwise(F.col("user_id").cast("string"))
         .alias("userCode"),
        F.when(F.col("hot"), F.lit("v")).otherwise((F.col("event_id") % 10).cast("string"))
         .alias("resourceId"),
        # hot events squeezed 100x in time: dense bursts with gaps around the GAP size
        F.when(F.col("hot"), F.expr("1704067200000 + (ms - 1704067200000) div 100"))
         .otherwise(F.col("ms")).cast("bigint").alias("ts"),
        F.lit(1).alias("level"), F.lit(1000).alias("video_length"), "event_id")


ORACLE = f"""
WITH ev AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE cast(user_id AS VARCHAR) END AS u,
         CASE WHEN event_id % 3 = 0 THEN 'v' ELSE cast(event_id % 10 AS VARCHAR) END AS r,
         CASE WHEN event_id % 3 = 0
              THEN 1704067200000 + ((epoch_us(ts) // 1000) - 1704067200000) // 100
              ELSE epoch_us(ts) // 1000 END AS ts, event_id
  FROM events),
f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > {GAP} THEN 1 ELSE 0 END b
      FROM ev WINDOW w AS (PARTITION BY u, r ORDER BY ts, event_id)),
n AS (SELECT *, sum(b) OVER (PARTITION BY u, r ORDER BY ts, event_id
                             ROWS UNBOUNDED PRECEDING) sid FROM f)
SELECT u, r, count(*) AS n, min(ts) AS t0, max(ts) AS t1 FROM n GROUP BY u, r, sid
"""


def test_hot_key_sessions_exact(spark):
    df = skewed(spark)
    got = sorted((r.userCode, r.resourceId, r.n, r.t0, r.t1) for r in
                 sessions.raw_sessions(df, GAP, BUCKET).collect())
    exp = sorted(duck(SF_MID).sql(ORACLE).fetchall())
    assert got == exp
    hot_events = df.where("userCode = 'hot'").count()
    assert hot_events * 3 >= df.count() - 3


def test_hot_key_groups_are_bounded(spark):
    """No stage after the cell aggregate sees more than bucket/gap rows of one group."""
    df = sessions.event_time(skewed(spark))
    cells = (df.withColumn("_cell", F.expr(f"(ts - pmod(ts, {GAP})) div {GAP}"))
               .groupBy("userCode", "resourceId", "_cell").count())
    per_bucket = (cells.withColumn("_bucket", F.expr(f"_cell div {BUCKET // GAP}"))
                       .groupBy("userCode", "resourceId", "_bucket").count())
    hot_events = df.where("userCode = 'hot'").count()
    biggest = per_bucket.agg(F.max("count")).first()[0]
    assert biggest <= BUCKET // GAP < hot_events
    # the hot key is spread over many (key, bucket) window groups
    assert per_bucket.where("userCode = 'hot'").count() >= 7     # ~7.2 h span, 1 h buckets

"""Views of FIXTURES.md §4: the reference's inputs derived from the test tables.

The synthetic ``events`` table plays the user log; ``customer``, ``part``,
``nation`` and ``supplier`` play the four dimensions. Every view has one row
for each row of its table. Unknown users come from customers in debt, whose id
is written differently; unknown videos from resource ids beyond the parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtally.sources.spread import spread

# The synthetic events are days apart per (user, video); the reference's 11 s
# gap would make every event its own session, so the oracle views use 3 days.
FIXTURE_GAP_MS = 3 * 86_400_000

# Fixed values of the fixture mapping (FIXTURES.md §4): event type -> code.
EVENT_CODES = {"view": "001", "click": "002", "purchase": "003", "signup": "004"}
OTHER_CODE = "005"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed log rows (LogBean columns + event_id) derived from ``events``."""
    ev = spread(_read(spark, sf_dir, "events"))
    code = F.lit(OTHER_CODE)
    for t, c in reversed(list(EVENT_CODES.items())):
        code = F.when(F.col("event_type") == t, F.lit(c)).otherwise(code)
    etype = F.when(F.col("event_type").isin("view", "click", "purchase"), "video") \
             .otherwise("other")
    k = F.get_json_object("props", "$.k").try_cast("int")
    # ten resources a user; the last users' lie beyond the part keys
    resource = F.col("user_id") * 14 + k % 10
    return ev.select(
        F.concat(F.lit("d"), (F.col("event_id") % 7).cast("string")).alias("deviceId"),
        F.col("user_id").cast("string").alias("userCode"),
        code.alias("eventCode"),
        etype.alias("eventType"),
        # events.ts is a UTC wall clock (TIMESTAMP_NTZ): epoch ms whatever the session zone
        F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
                      .cast("timestamp")).alias("ts"),
        resource.cast("string").alias("resourceId"),
        F.col("event_id"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines (``value``, ``event_id``) with planted defects.

    By ``event_id % 50`` (d: dirty, c: clean): 0 the first 10 characters (d),
    1 ``{}`` (d), 2 a NULL payload, 3 the object twice on one line (d), 4 text
    after the object (d), 5 two keys repeated, the last value counts (c), 6 ``ts``
    as text (c), 7 ``"ts":"abc"`` (d), 8 ``"Item":[]`` (d), 9 no event (c),
    10 ``"Item":{}`` (c), 11 ``ts`` as decimal text (c); every other line is the
    JSON of the log row with ``Item.resource_id``.
    """
    log = log_rows(spark, sf_dir)

    def line(ts, event=F.concat(F.lit('"event":"'), F.col("eventCode"), F.lit('",')),
             item=F.concat(F.lit('{"resource_id":"'), F.col("resourceId"), F.lit('"}'))):
        return F.concat(F.lit('{"deviceId":"'), F.col("deviceId"), F.lit('","userCode":"'),
                        F.col("userCode"), F.lit('",'), event, F.lit('"ts":'), ts,
                        F.lit(',"Item":'), item, F.lit("}"))

    ts = F.col("ts").cast("string")
    js = line(ts)
    kinds = {0: F.substring(js, 1, 10), 1: F.lit("{}"), 2: F.lit(None).cast("string"),
             3: F.concat(js, js), 4: F.concat(js, F.lit(" and more")),
             5: F.concat(F.lit('{"ts":1,"userCode":"nobody",'), F.substr(js, F.lit(2))),
             6: line(F.concat(F.lit('"'), ts, F.lit('"'))), 7: line(F.lit('"abc"')),
             8: line(ts, item=F.lit("[]")), 9: line(ts, event=F.lit("")),
             10: line(ts, item=F.lit("{}")), 11: line(F.concat(F.lit('"'), ts, F.lit('.9"')))}
    m = F.col("event_id") % 50
    value = None
    for k, v in kinds.items():
        value = F.when(m == k, v) if value is None else value.when(m == k, v)
    return log.select(value.otherwise(js).alias("value"), "event_id")


def doctor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    return c.select(
        F.when(F.col("c_acctbal") >= 0, key).otherwise(F.concat(F.lit("debt-"), key))
         .alias("user_id"),
        F.expr("c_custkey div 2").cast("int").alias("level"))


def video_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes 25 and 50 give the unusable lengths 0 and null."""
    size = F.col("p_size")
    length = F.when(size == 25, F.lit(0)).when(size < 50, size * 1000)
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("video_id"),
        length.cast("int").alias("video_length"))


def credit_rule_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One level a supplier, with the rule of its nation modulo five."""
    return _read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("R"), (F.col("s_nationkey") % 5).cast("string")).alias("rule_code"),
        F.col("s_suppkey").cast("int").alias("doctor_level"))


def credit_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task a nation, for the rule of its region: five tasks a session at any scale.
    Ten kinds of thresholds, the tenth without a length (unusable)."""
    k = F.col("n_nationkey")
    kind = k % 10 + 1
    pct = (F.lit(0.05) * kind).cast("decimal(4,2)").cast("string")
    length = F.when(kind < 10, F.concat(F.lit('"watchVideoLengthOfTime":'),
                                        (kind * 9000).cast("string"), F.lit(",")))
    detail = F.concat(F.lit("{"), F.coalesce(length, F.lit("")),
                      F.lit('"watchVideoWatchLengthOfTimePercentage":'), pct, F.lit("}"))
    return _read(spark, sf_dir, "nation").select(
        F.concat(F.lit("T"), k.cast("string")).alias("code"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("rule_code"),
        detail.alias("task_detail"))


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "doctor_info": doctor_info(spark, sf_dir),
        "video_info": video_info(spark, sf_dir),
        "credit_rule_config": credit_rule_config(spark, sf_dir),
        "credit_task": credit_task(spark, sf_dir),
    }

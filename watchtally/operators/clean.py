"""Parse raw JSON log lines, split clean and dirty rows.

One ``try_parse_json`` per line; every field is then a cheap path lookup on
the VARIANT value. The JSON is never re-parsed, and no Python runs per row.

A line is *dirty* (kept verbatim in the dirty branch) when
* it is not exactly one JSON value (not JSON, two objects on one line, text
  after the closing brace), or
* it has no ``Item`` object (a missing, null, array or scalar ``Item``,
  or a top-level value that is not an object), or
* ``ts`` is present but cannot be read as a long (``"abc"``, ``{}``).
``Item: {}`` is clean with a null ``resourceId``; a missing ``ts`` (or the
text ``""`` / ``"null"``) is clean with a null ``ts``; ``"12"`` reads as 12
and ``5.9`` / ``"5.9"`` as 5; of a repeated key the last value counts. A null payload is neither clean nor dirty (dropped at the
source).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtally.functions.getters import holds_one, lenient_long, parse_alone
from watchtally.functions.scalar import event_type

# the fields a line is read for; everything else in the object is ignored
_LINE_TYPE = ("struct<deviceId:string,userCode:string,event:string,ts:string,"
              "Item:struct<resource_id:string>>")


def parse_log(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw lines -> parsed columns plus ``is_dirty``; keeps ``value``.

    The line is parsed with a mark behind it (:func:`watchtally.functions.getters.parse_alone`),
    which shows a line with more than one value or with text after it. Lookups on the
    parsed VARIANT: one cast of the whole object to the line's struct (text fields read leniently, numbers as their text; null when
    the line is not an object or ``Item`` is not an object) and one lenient
    ``bigint`` read of ``ts``.

    The fields come out of a one-element ``inline`` generator. Filters on them
    (the clean/dirty split, the joins' inferred ``isnotnull``) cannot be pushed
    below a generator, so Catalyst cannot copy ``try_parse_json`` into each
    predicate: every line is parsed exactly once.
    """
    v = F.col(value_col)
    carry = [c for c in raw.columns if c != value_col]
    parsed = raw.where(v.isNotNull()).select(
        v.alias("value"), parse_alone(v).alias("_j"), *carry)
    rec = F.try_variant_get(F.col("_j"), "$[0]", _LINE_TYPE)
    ts = F.try_variant_get(F.col("_j"), "$[0].ts", "bigint")
    more = ~F.coalesce(holds_one(F.col("_j")), F.lit(False))
    parsed = parsed.select("value", *carry, rec.alias("_r"), ts.alias("_ts0"), more.alias("_more"))
    r, item = F.col("_r"), F.col("_r.Item")
    ts_text = r.getField("ts")
    no_ts = ts_text.isNull() | F.lower(ts_text).isin("", "null")
    parsed = parsed.select("*", lenient_long(F.col("_ts0"), ts_text).alias("_ts"),
                           no_ts.alias("_no_ts"))
    fields = F.struct(
        F.col("value"), *[F.col(c) for c in carry],
        r.getField("deviceId").alias("deviceId"),
        r.getField("userCode").alias("userCode"),
        r.getField("event").alias("eventCode"),
        event_type(r.getField("event")).alias("eventType"),
        F.col("_ts").alias("ts"),
        item.getField("resource_id").alias("resourceId"),
        (item.isNull() | F.col("_more") | (~F.col("_no_ts") & F.col("_ts").isNull())).alias("is_dirty"),
    )
    return parsed.select(F.inline(F.array(fields)))


LOG_COLUMNS = ["deviceId", "userCode", "eventCode", "eventType", "ts", "resourceId"]


def clean_branch(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Main output: typed log rows (P5 projection + rename)."""
    return parsed.where(~F.col("is_dirty")).select(*LOG_COLUMNS, *keep)


def dirty_branch(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Side output: the raw line as it arrived."""
    return parsed.where(F.col("is_dirty")).select("value", *keep)


def clean_log(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return clean_branch(parse_log(raw), keep)


def dirty_log(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return dirty_branch(parse_log(raw), keep)

"""Log and topic sources, batch or streaming.

Sources are chosen by ``format`` + ``options`` (``kafka`` on a cluster,
``text`` files in tests), so one code path serves both. Every source yields
one ``value: string`` column; null payloads are dropped (S1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchtally import schemas
from watchtally.functions.getters import get_int, get_long, get_string, parse_alone, the_object
from watchtally.sources.spread import spread


def read_lines(spark: SparkSession, fmt: str = "text", path: str | None = None,
               options: dict | None = None, stream: bool = False,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw lines as ``value`` (kafka: ``cast(value as string)``), nulls dropped.

    ``keep`` carries source columns along (e.g. kafka ``offset``, an id)."""
    r = spark.readStream if stream else spark.read
    r = r.format(fmt).options(**(options or {}))
    df = spread(r.load(path) if path else r.load())
    return drop_null_lines(df, keep)


def drop_null_lines(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Payloads as text, null ones dropped."""
    df = df.select(F.col("value").cast("string").alias("value"), *keep)
    return df.where(F.col("value").isNotNull())


def parse_topic(lines: DataFrame) -> DataFrame:
    """DWD_VIDEO_INFO columns of every topic line, its ``value`` and ``is_bad``.

    A record is one JSON object and nothing else, as in the reference's parse of a
    whole payload: two records on a line, text behind one, or another kind of value make
    the line bad. Fields are read with the lenient getters (``"12"`` reads as 12).
    """
    parsed = lines.select("value", parse_alone("value").alias("_p"))
    parsed = parsed.select("value", the_object("_p").alias("_j"))
    j = F.col("_j")
    read = {T.StringType: get_string, T.LongType: get_long, T.IntegerType: get_int}
    fields = F.struct(*[read[type(f.dataType)](j, f.name).alias(f.name)
                        for f in schemas.DWD_VIDEO_INFO.fields],
                      F.col("value"), j.isNull().alias("is_bad"))
    # one parse per line: nothing is pushed below the generator (see operators.clean)
    return parsed.select(F.inline(F.array(fields)))


def good_dwd(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """The records of :func:`parse_topic`; ``strict`` fails the query at a bad line."""
    if strict:
        # the flag is computed from the check, so that no rule can drop it
        message = F.concat(F.lit("not a topic record: "), F.col("value"))
        checked = F.when(F.col("is_bad"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        parsed = parsed.where(checked)
    else:
        parsed = parsed.where(~F.col("is_bad"))
    return parsed.select(*schemas.DWD_VIDEO_INFO.names)


def bad_dwd(parsed: DataFrame) -> DataFrame:
    """The lines of :func:`parse_topic` that are no record, as they arrived."""
    return parsed.where(F.col("is_bad")).select("value")


def parse_dwd(lines: DataFrame, strict: bool = True) -> DataFrame:
    """JSON topic rows -> DWD_VIDEO_INFO columns.

    A bad line fails the query under ``strict``, like the reference's unguarded parse;
    otherwise it gives no row (:func:`bad_dwd` has it, job 2's ``reject_sink`` keeps it).
    """
    return good_dwd(parse_topic(lines), strict)


def read_dwd(spark: SparkSession, fmt: str = "text", path: str | None = None,
             options: dict | None = None, stream: bool = False,
             strict: bool = True) -> DataFrame:
    """The enriched video topic as typed rows."""
    return parse_dwd(read_lines(spark, fmt, path, options, stream), strict)

"""Scalar functions of SURVEY §2.2 / §2.6 as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the event codes that mark a
# video event, and the two event types.
VIDEO_EVENT_CODES = ("001", "002", "003")
VIDEO = "video"
OTHER = "other"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def event_type(event) -> Column:
    """P3: '001'/'002'/'003' are video events, anything else (null too) is other."""
    e = _c(event)
    return F.when(e.isin(*VIDEO_EVENT_CODES), F.lit(VIDEO)).otherwise(F.lit(OTHER))


def json_text(doc, path: str) -> Column:
    """JSON path to text; null when absent or the document is not JSON."""
    return F.get_json_object(_c(doc), path)


def json_int(doc, path: str) -> Column:
    """F1 (RETURNING INTEGER): null when absent, not JSON or not an integer."""
    return F.get_json_object(_c(doc), path).try_cast("int")


def json_double(doc, path: str) -> Column:
    """F1 (RETURNING DOUBLE): null when absent, not JSON or not a number."""
    return F.get_json_object(_c(doc), path).try_cast("double")


def half_up(x, scale: int = 0) -> Column:
    """Round half up like ``Math.round(x * 10^s) / 10^s`` (not banker's,
    not Spark's decimal ``round``): ``floor(x * 10^s + 0.5) / 10^s``."""
    m = float(10 ** scale)
    v = F.floor(_c(x) * F.lit(m) + F.lit(0.5))
    return v / F.lit(m) if scale else v


def state_key(user, video, task, prefix: str = "video") -> Column:
    """``prefix:user:video:task``; a null part prints as 'null' like string
    concatenation does. Grouping always uses the three columns, never this text."""
    parts = [F.coalesce(_c(p).cast("string"), F.lit("null")) for p in (user, video, task)]
    return F.concat_ws(":", F.lit(prefix), *parts)


def parse_bool(x) -> Column:
    """only 'true' (any case) is true; null and everything else are false."""
    return F.coalesce(F.lower(_c(x)) == F.lit("true"), F.lit(False))

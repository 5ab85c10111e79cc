"""Epoch-millisecond <-> text conversions with an explicit zone.

All four are independent of the session time zone: wall-clock values are
moved between zones with ``convert_timezone`` on TIMESTAMP_NTZ values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the two text layouts (note the
# colon before the milliseconds) and the zone used when parsing text.
FULL_PATTERN = "yyyy-MM-dd HH:mm:ss:SSS"
DATE_PATTERN = "yyyy-MM-dd"
PARSE_ZONE = "+08:00"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _wall_clock(ts_ms, zone: str) -> Column:
    """Epoch ms -> TIMESTAMP_NTZ wall clock in ``zone``."""
    ntz_session = F.timestamp_millis(_c(ts_ms)).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(zone), ntz_session)


def _epoch_ms(wall_ntz: Column, zone: str) -> Column:
    """TIMESTAMP_NTZ wall clock in ``zone`` -> epoch ms."""
    in_session = F.convert_timezone(F.lit(zone), F.current_timezone(), wall_ntz)
    return F.unix_millis(in_session.cast("timestamp"))


def fmt_datetime(ts_ms, zone: str = "UTC") -> Column:
    """epoch ms -> 'yyyy-MM-dd HH:mm:ss:SSS' in ``zone``."""
    return F.date_format(_wall_clock(ts_ms, zone), FULL_PATTERN)


def fmt_date(ts_ms, zone: str = "UTC") -> Column:
    """F8: epoch ms -> 'yyyy-MM-dd' in ``zone``."""
    return F.date_format(_wall_clock(ts_ms, zone), DATE_PATTERN)


def ts_from_text(text, zone: str = PARSE_ZONE) -> Column:
    """'yyyy-MM-dd HH:mm:ss:SSS' at ``zone`` -> epoch ms (null if unparsable)."""
    wall = F.try_to_timestamp(_c(text), F.lit(FULL_PATTERN)).cast("timestamp_ntz")
    return _epoch_ms(wall, zone)


def ts_from_date(text, zone: str = PARSE_ZONE) -> Column:
    """'yyyy-MM-dd' at ``zone`` -> epoch ms of its midnight.

    The reference appends a time without milliseconds and then fails to parse
    it (SURVEY Q12); here a date-only text works.
    """
    wall = F.try_to_timestamp(_c(text), F.lit(DATE_PATTERN)).cast("timestamp_ntz")
    return _epoch_ms(wall, zone)

"""Column-level functions (JVM-side expressions only, no Python UDFs)."""

from watchtally.functions.scalar import (
    event_type, half_up, json_double, json_int, json_text, parse_bool, state_key,
)
from watchtally.functions.getters import (
    get_double_value, get_int_value, get_long, get_long_value, get_string,
)
from watchtally.functions.timefmt import (
    fmt_date, fmt_datetime, ts_from_date, ts_from_text,
)

__all__ = [
    "event_type", "half_up", "json_double", "json_int", "json_text", "parse_bool",
    "state_key", "get_double_value", "get_int_value", "get_long", "get_long_value",
    "get_string", "fmt_date", "fmt_datetime", "ts_from_date", "ts_from_text",
]

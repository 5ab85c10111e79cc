"""Typed getters on a parsed JSON object (a VARIANT column).

Boxed getters return null when the field is missing or unusable; the
primitive ``*Value`` getters default to 0 like the reference's JSON library.
Strings and numbers are coerced leniently (``"12"`` reads as 12, 5.9 as 5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Stands behind a line's text while it is parsed: what follows the first value shows
# up between the two, or keeps it from being read.
_END = "end of line"


def parse_alone(text) -> Column:
    """The VARIANT of a line, wrapped so that :func:`the_object` can tell whether it
    holds one JSON object and nothing else (text behind a value is no parse error)."""
    return F.try_parse_json(F.concat(F.lit("["), _v(text), F.lit(f', "{_END}"]')))


def holds_one(parsed) -> Column:
    """Whether a line parsed by :func:`parse_alone` is one JSON value (null: no JSON)."""
    p = _v(parsed)
    return ((F.try_variant_get(p, "$[1]", "string") == F.lit(_END))
            & F.try_variant_get(p, "$[2]", "variant").isNull())


def the_object(parsed) -> Column:
    """The object of a line parsed by :func:`parse_alone`; null when the line is not
    exactly one object (no JSON, several values, text behind it, another kind of value)."""
    p = _v(parsed)
    alone = holds_one(p) & F.try_variant_get(p, "$[0]", "map<string,variant>").isNotNull()
    return F.when(alone, F.try_variant_get(p, "$[0]", "variant"))


def _v(j) -> Column:
    return F.col(j) if isinstance(j, str) else j


def get_string(j, field: str) -> Column:
    return F.try_variant_get(_v(j), f"$.{field}", "string")


def lenient_long(value: Column, text: Column) -> Column:
    """A long from a VARIANT's ``bigint`` read and its text: no value for absent,
    ``""`` and ``"null"``; decimal text is truncated; null when unusable."""
    blank = text.isNull() | F.lower(text).isin("", "null")
    cut = F.when(text.contains("."), text.try_cast("double").try_cast("bigint"))
    return F.when(~blank, F.coalesce(value, cut))


def get_long(j, field: str) -> Column:
    return lenient_long(F.try_variant_get(_v(j), f"$.{field}", "bigint"), get_string(j, field))


def get_long_value(j, field: str) -> Column:
    return F.coalesce(get_long(j, field), F.lit(0).cast("bigint"))


def get_int(j, field: str) -> Column:
    return get_long(j, field).try_cast("int")


def get_int_value(j, field: str) -> Column:
    return F.coalesce(get_int(j, field), F.lit(0))


def get_double_value(j, field: str) -> Column:
    return F.coalesce(F.try_variant_get(_v(j), f"$.{field}", "double"), F.lit(0.0))

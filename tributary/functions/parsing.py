"""Tolerant casts, JSON payload fields and nested access."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tributary.functions.temporal import WALL_CLOCK

# Texts accepted as special doubles. Spark's own cast would also take a Java
# suffix ("7.1d", "7.1f"), which is not a number in the warehouse dialect.
NUMBER_CHARACTERS = "0123456789+-.eE \t\r\n"
SPECIAL_NUMBERS = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")

# A full date is required; "2024", "2024-01" and "T12:30" are not timestamps. A time has
# at least its first colon, may be cut short after a colon, and a zone is not looked at.
DATE_SHAPE = r"\d{4}-\d{1,2}-\d{1,2}"
TIME_SHAPE = r"(?=\d{1,2}:)\d{1,2}(?::\d{1,2}(?::\d{1,2}(?:\.\d*)?)?)?"
ZONE_SHAPE = r"Z|[+-]\d{2}(?::?\d{2})?|\s[\w/+-]*|\s+"
TIMESTAMP_SHAPE = rf"^\s*({DATE_SHAPE}[ T]{TIME_SHAPE}|{DATE_SHAPE}$):?(?:{ZONE_SHAPE})?$"


def safe_double(text: Column) -> Column:
    """Text to double, NULL where it is not a number."""
    plain = F.translate(text, NUMBER_CHARACTERS, "") == ""
    special = F.lower(F.trim(text)).isin(*SPECIAL_NUMBERS)
    return F.when(plain | special, text.try_cast("double"))


def safe_timestamp(text: Column) -> Column:
    """Text to wall-clock timestamp, NULL where it is not a timestamp."""
    return F.regexp_extract(text, TIMESTAMP_SHAPE, 1).try_cast(WALL_CLOCK)


def safe_int(value: Column) -> Column:
    """Number or text to integer, NULL where it is none or does not fit.

    Fractions round as in the warehouse dialect: doubles half to even, decimals and texts
    half away from zero. The type is known when the plan is made, so one branch remains.
    """
    text = value.cast("string")
    number = F.when(F.translate(text, NUMBER_CHARACTERS, "") == "", text).try_cast("decimal(38,9)")
    binary = F.rint(value.try_cast("double")).try_cast("int")
    return F.when(F.typeof(value).isin("double", "float"), binary).otherwise(
        F.round(number, 0).try_cast("int")
    )


def json_fields(payload: Column, names: Iterable[str]) -> Column:
    """Fields of a JSON object as text columns of the same names, from one parse per row.

    For use in ``select``. Cheaper than ``from_json`` into text fields, which sets up a
    writer for every number it turns back into text.
    """
    names = list(names)
    return F.json_tuple(payload, *names).alias(*names)


def nth(items: Column, position: int) -> Column:
    """Element at a 1-based position, NULL past the end."""
    return F.get(items, F.lit(position - 1))


def length_or_zero(items: Column) -> Column:
    """Number of elements; a missing list has none."""
    return F.coalesce(F.array_size(items), F.lit(0)).cast("long")

"""Column helpers on edge values."""

import math

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tributary.functions.classify import bands, keep_within, lookup, outside_flag
from tributary.functions.numeric import or_zero, percent, ratio, round_half_away
from tributary.functions.parsing import (
    json_fields,
    length_or_zero,
    nth,
    safe_double,
    safe_int,
    safe_timestamp,
)
from tributary.functions.temporal import (
    day_of,
    days_between,
    hour_of,
    month_of,
    week_of,
    weekday_from_sunday,
)


def column(spark, kind, items, make):
    df = spark.createDataFrame([(item,) for item in items], f"x {kind}")
    return [row[0] for row in df.select(make(F.col("x"))).collect()]


def test_rounding_scales_first(spark):
    got = column(spark, "double", [1.005, 2.5, -2.5, 0.125, None], lambda x: round_half_away(x, 2))
    assert got == [1.0, 2.5, -2.5, 0.13, None]
    assert column(spark, "double", [2.25, -2.25], lambda x: round_half_away(x, 1)) == [2.3, -2.3]


def test_ratio_and_percent_of_zero_are_null(spark):
    assert column(spark, "long", [0, 4, None], lambda x: ratio(F.lit(1), x)) == [None, 0.25, None]
    assert column(spark, "long", [3, 0], lambda x: percent(F.lit(1), x)) == [33.33, None]
    assert column(spark, "long", [None, 5], or_zero) == [0, 5]


@pytest.mark.parametrize(
    "text, value",
    [
        ("7.1", 7.1), (" 7.1 ", 7.1), ("-1e3", -1000.0), (".5", 0.5), ("5.", 5.0),
        ("7.1d", None), ("7.1f", None), ("0x1p3", None), ("abc", None), ("", None),
        ("1 2", None), ("1,5", None), ("--1", None), (None, None), ("[1]", None),
        ("inf", math.inf), ("-Infinity", -math.inf),
    ],
)
def test_safe_double(spark, text, value):
    assert column(spark, "string", [text], safe_double) == [value]


def test_safe_double_keeps_nan(spark):
    assert math.isnan(column(spark, "string", ["NaN"], safe_double)[0])


@pytest.mark.parametrize(
    "text, value",
    [
        ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
        ("2024-01-02T03:04:05", "2024-01-02 03:04:05"),
        (" 2024-1-2", "2024-01-02"),
        ("2024-01-02 03:04 PY", "2024-01-02 03:04:00"),
        ("2024-01-02 03:04: P", "2024-01-02 03:04:00"),
        ("2024-01-02 03:", "2024-01-02 03:00:00"),
        ("2024-01-02 03:04+02", "2024-01-02 03:04:00"),
        ("2024-01-02 03", None), ("2024-01-02 ", None), ("2024-01-02Z", None),
        ("2024", None), ("2024-01", None), ("T12:30", None), ("", None), (None, None),
        ("2024-02-30 00:00:00", None), ("2024-01-02 25:00:00", None), ("junk", None),
    ],
)
def test_safe_timestamp(spark, text, value):
    assert column(spark, "string", [text], safe_timestamp) == [value and ts(value)]


def test_safe_int_out_of_range(spark):
    assert column(spark, "long", [7, 2**31], safe_int) == [7, None]


def test_json_fields(spark):
    payload = '{"a": 1.5, "b": null, "c": "x", "d": [1, 2], "e": 12345678901234567890, "f": 1e-3}'
    df = spark.createDataFrame([(payload,), ("{}",), ("no json",), (None,)], "x string")
    got = [tuple(row) for row in df.select(json_fields(F.col("x"), "abcdefz")).collect()]
    assert got[0] == ("1.5", None, "x", "[1,2]", "12345678901234567890", "0.001", None)
    assert got[1:] == [(None,) * 7] * 3


def test_lists(spark):
    items = [["a", "b"], [], None]
    assert column(spark, "array<string>", items, lambda x: nth(x, 1)) == ["a", None, None]
    assert column(spark, "array<string>", items, lambda x: nth(x, 3)) == [None] * 3
    assert column(spark, "array<string>", items, length_or_zero) == [2, 0, 0]


def test_calendar_ignores_the_session_zone(spark):
    # Clocks went from 00:00 to 01:00 on this day in this zone.
    moment = [ts("2024-10-06 00:30:12")]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Asuncion")
    try:
        got = {
            make: column(spark, "timestamp_ntz", moment, make)[0]
            for make in (hour_of, day_of, week_of, month_of, weekday_from_sunday)
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[hour_of] == got[day_of] == ts("2024-10-06")
    assert got[week_of] == ts("2024-09-30")
    assert got[month_of] == ts("2024-10-01")
    assert got[weekday_from_sunday] == 0


def test_days_between_counts_midnights(spark):
    start = F.lit("2024-01-01 23:59:00").cast("timestamp_ntz")
    later = [ts("2024-01-02 00:01:00"), ts("2024-01-01 00:00:00"), None]
    assert column(spark, "timestamp_ntz", later, lambda x: days_between(start, x)) == [1, 0, None]


def test_ranges_are_closed(spark):
    items = [4.0, 10.0, 3.9, 10.1, None, math.nan]
    assert column(spark, "double", items, lambda x: keep_within(x, 4, 10)) == [4.0, 10.0] + [None] * 4
    assert column(spark, "double", items, lambda x: outside_flag(x, 4, 10)) == [0, 0, 1, 1, 0, 1]


def test_lookup_and_bands(spark):
    named = column(spark, "string", ["a", "z", None], lambda x: lookup(x, {"a": "A"}, x))
    assert named == ["A", "z", None]
    label = column(
        spark, "int", [9, 5, 1, None],
        lambda x: bands([(x > 8, "high"), (x > 4, "middle")], "low"),
    )
    assert label == ["high", "middle", "low", "low"]

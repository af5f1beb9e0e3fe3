"""Calendar helpers on wall-clock timestamps.

They go through DATE, never through the session time zone: ``date_trunc`` would
convert a ``timestamp_ntz`` to an instant first, and in zones that change their
clock at midnight that moves some days to 01:00.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WALL_CLOCK = "timestamp_ntz"


def day_of(ts: Column) -> Column:
    return ts.cast("date").cast(WALL_CLOCK)


def week_of(ts: Column) -> Column:
    """Monday of the week."""
    return F.trunc(ts.cast("date"), "week").cast(WALL_CLOCK)


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast(WALL_CLOCK)


def hour_of(ts: Column) -> Column:
    return day_of(ts) + F.make_dt_interval(hours=F.hour(ts))


def year_number(ts: Column) -> Column:
    return F.year(ts).cast("long")


def weekday_from_sunday(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(ts) - F.lit(1)


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights between two timestamps."""
    return F.datediff(end, start).cast("long")


def utc_wall_clock() -> Column:
    """The present moment as a UTC wall-clock timestamp, whatever the session's time zone.

    Counted from the epoch: local time repeats an hour when clocks are set back.
    """
    seconds = (F.unix_micros(F.current_timestamp()) / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast(WALL_CLOCK) + F.make_dt_interval(secs=seconds)

"""Rounding, ratios and null guards."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, scaling first.

    Scaling before rounding gives 1.0 for ``round(1.005, 2)``: the product
    100.49999999999999 is what gets rounded. Spark's own ``round`` works on the
    shortest decimal text of the value and gives 1.01.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` in double precision; NULL where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL where ``whole`` is zero.

    The factor is applied before the cast so that money stays exact until the division.
    """
    return round_half_away(ratio(part * F.lit(100), whole), digits)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))

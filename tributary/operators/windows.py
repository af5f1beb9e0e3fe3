"""Row windows over one ordered series per group.

They are meant for series that were aggregated first (one row per group and day), so
that the rows of a group are bounded by the calendar and not by the data volume. All
three share the partitioning and order of ``series``: one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec, functions as F


def series(group: str, *order: str) -> WindowSpec:
    return Window.partitionBy(group).orderBy(*[F.asc_nulls_last(name) for name in order])


def previous(value: str, over: WindowSpec) -> Column:
    """Value of the previous row; gaps in the order column are not filled."""
    return F.lag(value).over(over)


def trailing_mean(value: str, rows: int, over: WindowSpec) -> Column:
    """Mean of the last ``rows`` rows including the present one."""
    return F.avg(value).over(over.rowsBetween(1 - rows, Window.currentRow))


def group_mean(value: str, group: str) -> Column:
    """Mean over the whole group, later rows included."""
    return F.avg(value).over(Window.partitionBy(group))

"""Grouped aggregates shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Number of sub-buckets used by ``collapse``. It only has to differ from one.
BUCKETS = 64


def row_count() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; false and NULL count as 0."""
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_where(value: Column, condition: Column) -> Column:
    """Sum over the rows where the condition holds, 0 for the others."""
    return F.sum(F.when(condition, value).otherwise(0))


def collapse(df: DataFrame, key: str | Sequence[str], *others: str, **totals: Column) -> DataFrame:
    """One row per ``key`` (and ``others``) as the side of a later join on ``key``.

    A key may be several columns; rows with a null in it are left out.

    Rows of a hot key are combined map-side, so the result has no hot key and the
    join cannot pair up two large groups.

    The grouping carries a bucket of the key as well. Groups stay the same, since the
    bucket depends on the key alone, but the aggregate is then not partitioned by
    ``key`` itself, and Spark puts a plain exchange between it and the join. Adaptive
    execution splits hot partitions of the *other* side only when both inputs of the
    join are plain exchanges; straight on top of an aggregate it leaves them whole.
    The exchange moves the combined rows only, which are the smaller side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bucket = F.pmod(F.hash(*keys), F.lit(BUCKETS))
    known = reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])
    keyed = df.where(known).withColumn("_bucket", bucket)
    grouped = keyed.groupBy(*keys, *others, "_bucket")
    return grouped.agg(*[value.alias(name) for name, value in totals.items()]).drop("_bucket")

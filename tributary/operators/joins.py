"""Equi-joins whose keys may be skewed on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators.aggregates import collapse, row_count


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that keeps working when either side has many rows for one key.

    Adaptive execution splits a hot partition on the left of a left join but never on its
    right. So the rows that match come from an inner join, of which both sides can be
    split, and the others, those without a key included, from an anti join against one
    row per key. There is one plan for all keys, and nothing runs to define it.
    """
    matched = left.join(right, key, "inner")
    keys = collapse(right, key, _rows=row_count()).select(key)
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
    unmatched = left.join(keys, key, "left_anti").select("*", *absent)
    return matched.unionByName(unmatched)

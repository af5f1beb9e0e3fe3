"""Global sorts for final output."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Sort by ``keys``, NULLs last; a leading ``-`` means descending.

    Keys that make the order unique belong at the end: range partitioning then has
    something to split a frequent leading value on, and the order is repeatable.
    """
    by = [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in keys]
    return df.orderBy(*by)

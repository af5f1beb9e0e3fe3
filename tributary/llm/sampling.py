"""Bounded samples for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F


def hashed_sample(df: DataFrame, limit: int, *keys: str) -> list[Row]:
    """At most ``limit`` rows of ``df`` with distinct ``keys``: all, or those with the smallest hashes.

    The distinct hashes are counted, and a cut on the hash lets a little fewer than
    ``limit`` of them through. Rows with equal keys are then combined, map-side before they
    shuffle, into the smallest of them, so that a group of copies of any size is one row of
    the sample. Each task sends its share of the sample only, however many tasks there are.
    The same rows give the same sample, in whatever order they are stored.
    """
    mark = F.xxhash64(*keys)
    total = df.select(mark.alias("_mark")).distinct().count()
    rows = df.withColumn("_mark", mark)
    if total > limit:
        cut = -(1 << 63) + int((1 << 64) * 0.95 * limit / total)
        rows = rows.where(F.col("_mark") < cut)
    others = [name for name in df.columns if name not in keys]
    rows = rows.groupBy(*keys, "_mark").agg(F.min(F.struct(F.lit(0).alias("_"), *others)).alias("_row"))
    rows = rows.select(*[F.col(name) if name in keys else F.col(f"_row.{name}") for name in df.columns], "_mark")
    found = sorted(rows.collect(), key=lambda row: (row["_mark"], repr(row)))
    return found[:limit]

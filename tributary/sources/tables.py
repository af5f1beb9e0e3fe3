"""Declared source tables and how to reach them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Source tables by group.
SOURCE_GROUPS = {
    "raw": (
        "pokemon",
        "issues",
        "pull_requests",
        "branches",
        "repositories",
        "stargazers",
        "market_chart",
    ),
    "ecommerce": (
        "website_sessions",
        "website_pageviews",
        "products",
        "orders",
        "order_items",
        "order_item_refunds",
    ),
    "hidro": ("hidro_estacion_itabo_guazu", "hidro_estacion_pozuelo_puente"),
}
SOURCE_TABLES = tuple(name for group in SOURCE_GROUPS.values() for name in group)

Loader = Callable[[str], DataFrame]


def _declared(name: str) -> str:
    if name not in SOURCE_TABLES:
        raise KeyError(f"not a declared source table: {name}")
    return name


def from_database(spark: SparkSession, database: str) -> Loader:
    """Sources as tables of one catalog database."""
    return lambda name: spark.table(f"{database}.{_declared(name)}")


def from_jdbc(
    spark: SparkSession,
    url: str,
    keys: Mapping[str, str],
    partitions: int = 64,
    **options: str,
) -> Loader:
    """Sources as tables of an operational database.

    ``keys`` names a numeric, date or timestamp column, best an indexed one, for the tables
    that several tasks read: each reads a range of it. The bounds are the column's own,
    asked of the database when the source is loaded, so rows beyond an old bound do not
    pile up in the last range. Null keys are read with the first range. Tables without a
    key are read by one task. ``options`` go to the reader: user, password, fetchsize, driver.
    """

    def load(name: str) -> DataFrame:
        table = _declared(name)
        reader = spark.read.format("jdbc").options(url=url, **options)
        if table not in keys:
            return reader.option("dbtable", table).load()
        key = keys[table]
        bounds = reader.option("query", f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}").load().first()
        reader = spark.read.format("jdbc").options(url=url, **options).option("dbtable", table)
        if bounds[0] is None:  # no rows, or no keys to divide them by
            return reader.load()
        ranges = {"partitionColumn": key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1])}
        return reader.options(numPartitions=partitions, **ranges).load()

    return load


def from_parquet(spark: SparkSession, root: str) -> Loader:
    """Sources as one Parquet folder or file per table under ``root``."""
    return lambda name: spark.read.parquet(f"{root.rstrip('/')}/{_declared(name)}")


def from_frames(frames: Mapping[str, DataFrame]) -> Loader:
    """Sources held as DataFrames."""
    return lambda name: frames[_declared(name)]

"""Writing stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def full_refresh(df: DataFrame, table: str, keep_if_empty: bool = False) -> int:
    """Replace ``table`` with the rows of ``df``; return their number.

    The rows go to a new folder of the database. When it is complete, one catalog step
    points the table to it: readers see the old rows or the new ones, and nothing is
    copied or renamed. Two loads at once write different folders, and the later switch
    wins. A load that fails, or is empty with ``keep_if_empty``, leaves the table as it
    was. The rows before stay until the next refresh, for queries that still read them.

    If the columns change, the table is dropped and created again over the new folder,
    which are two catalog steps. Counting the written files reads their footers only.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    folder = f"{root}/{name}__{uuid.uuid4().hex[:12]}"
    df.write.parquet(folder)
    written = spark.read.parquet(folder) if df.columns else df
    rows = written.count()
    if keep_if_empty and rows == 0:
        _remove(spark, folder)
        return 0
    target = f"{database}.{name}"
    before = None
    if spark.catalog.tableExists(target):
        before = _location(spark, target)
        if spark.table(target).schema == written.schema:
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{folder}'")
        else:
            spark.sql(f"DROP TABLE {target}")
            spark.sql(f"CREATE TABLE {target} USING parquet LOCATION '{folder}'")
        spark.catalog.refreshTable(target)
    else:
        spark.sql(f"CREATE TABLE {target} USING parquet LOCATION '{folder}'")
    _remove_others(spark, root, name, {folder, before})
    return rows


def append(df: DataFrame, table: str) -> None:
    """Add rows to ``table``. Rows that were loaded before are not removed."""
    df.write.format("parquet").mode("append").saveAsTable(table)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _remove_others(spark: SparkSession, root: str, name: str, kept: set[str | None]) -> None:
    """Folders of earlier refreshes of a table, except those in ``kept``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}__*")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {folder.rsplit("/", 1)[1] for folder in kept if folder}
    for status in system.globStatus(path) or []:
        folder = status.getPath()
        if folder.getName() not in names and len(folder.getName()) == len(name) + 14:
            system.delete(folder, True)

"""Shared scratch space for files that later stages read back."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse.

    Both are reachable by all executors. The warehouse path is qualified by the file
    system the session uses, so that it means the same folder on every machine.
    """
    shared = spark.conf.get(SETTING, None)
    if shared:
        return shared.rstrip("/")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.sql.warehouse.dir"))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return f"{path.makeQualified(system.getUri(), system.getWorkingDirectory())}/_scratch"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name in the shared folder; it is removed when the process ends."""
    folder = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, folder)
    return folder


def stored(df: DataFrame, purpose: str, replaces: DataFrame | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    This cuts the lineage: a lost executor costs the tasks it ran, not the stages before.
    ``replaces`` is a frame this function returned earlier that nobody reads any more, as
    the last round of an iteration; its files go once the new ones are complete.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, purpose)
    df.write.parquet(folder)
    found = spark.read.schema(df.schema).parquet(folder)
    found.scratch_folder = folder
    if replaces is not None:
        discard(replaces)
    return found


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that ``stored`` returned; other frames are left alone."""
    folder = getattr(df, "scratch_folder", None)
    if folder is not None:
        _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may be gone; files left behind are only scratch
        pass

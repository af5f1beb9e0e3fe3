"""Session set-up shared by the command line, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Applied only where the cluster has not chosen a value of its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Skew splitting is worth an extra exchange: one key may hold a third of a table.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Exchanges start with so many partitions and adaptive execution merges the small ones.
    # It never splits those of an aggregate, so the number has to suit large inputs.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
}
# Where a fixed number of partitions is chosen, that is the number to start with.
FIXED_PARTITIONS = "spark.sql.shuffle.partitions"


def get_session(app_name: str = "tributary", **conf: str) -> SparkSession:
    """Return a session, as in ``get_session(**{"spark.master": "local[8]"})``.

    What the cluster, ``conf`` or a running session has set is left alone; the rest gets
    the defaults above.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    chosen = spark._jsparkSession.sessionState().conf()
    for key, value in DEFAULTS.items():
        fixed = key.endswith("initialPartitionNum") and chosen.contains(FIXED_PARTITIONS)
        if not chosen.contains(key) and not fixed:
            spark.conf.set(key, value)
    return spark

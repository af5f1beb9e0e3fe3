"""Joins under skew: same rows as the plain join, and plans that can be split."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from tributary.operators.aggregates import collapse
from tributary.operators.joins import left_join


def skewed(spark, rows, spread, name):
    """A third of the rows on key 7, some without a key."""
    key = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 41 == 1, None)
        .otherwise(F.col("id") % spread)
    )
    return spark.range(rows).select(key.alias("k"), F.col("id").alias(name))


@pytest.mark.parametrize("rows, spread", [(300, 90), (900, 5), (0, 1)])
def test_left_join_equals_the_plain_join(spark, rows, spread):
    left, right = skewed(spark, rows, spread, "l"), skewed(spark, 2 * rows, 250, "r")
    got = left_join(left, right, "k")
    assert values(got, "k", "l", "r") == values(left.join(right, "k", "left"), "k", "l", "r")


def test_left_join_on_text_keys(spark):
    left = skewed(spark, 90, 30, "l").withColumn("k", F.concat(F.lit("it's "), F.col("k")))
    right = skewed(spark, 90, 45, "r").withColumn("k", F.concat(F.lit("it's "), F.col("k")))
    got = left_join(left, right, "k")
    assert values(got, "k", "l", "r") == values(left.join(right, "k", "left"), "k", "l", "r")


def test_left_join_is_defined_without_a_job(spark):
    left, right = skewed(spark, 300, 90, "l"), skewed(spark, 600, 250, "r")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    left_join(left, right, "k")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_collapse_groups_by_the_key_alone(spark):
    rows = skewed(spark, 3000, 900, "l")
    got = collapse(rows, "k", n=F.count("l"), total=F.sum("l"))
    expected = rows.where("k is not null").groupBy("k").agg(F.count("l"), F.sum("l"))
    assert values(got) == values(expected)


@pytest.fixture
def small_skew_limits(spark):
    """Treat a few kilobytes as a hot partition, and never broadcast."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_session_is_split_next_to_a_collapsed_side(spark, small_skew_limits):
    visits = skewed(spark, 300_000, 250_000, "v").repartition(8)
    orders = skewed(spark, 30_000, 25_000, "o").repartition(8)
    per_key = collapse(orders, "k", n=F.count("o"))
    plan = executed_plan(
        visits.join(per_key, "k", "left").groupBy(F.col("v") % 5).agg(F.sum("n"))
    )
    assert "skew=true" in plan


def test_hot_right_side_is_split(spark, small_skew_limits):
    orders = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("l")).repartition(8)
    refunds = skewed(spark, 300_000, 250_000, "r").repartition(8)
    joined = left_join(orders, refunds, "k")
    plan = executed_plan(joined.groupBy((F.col("l") + F.col("r")) % 5).count())
    assert "Inner" in plan and "LeftAnti" in plan and "skew=true" in plan
    assert joined.count() == orders.join(refunds, "k", "left").count()

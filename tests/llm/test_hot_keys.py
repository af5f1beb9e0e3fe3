"""Joins of the corpus operators with a hot key: adaptive execution splits it."""

import pytest
from pyspark.sql import functions as F

from tributary.llm import components, line_dedup, ngram_join, quality_rules, url_filters
from tributary.sources.scratch import stored

LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    """Treat a few kilobytes as a hot partition, and never broadcast."""
    before = {key: spark.conf.get(key, None) for key in LIMITS}
    for key, value in LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hub_of_a_component_is_split(spark, small_limits):
    ids = spark.range(1, 100_001).repartition(8)
    below = stored(ids.select(F.col("id").alias("u"), F.lit(0).cast("long").alias("v")), "star")
    assert "skew=true" in plan(components._large_star(below))
    above = stored(ids.select(F.lit(1 << 40).alias("u"), F.col("id").alias("v")), "star")
    assert "skew=true" in plan(components._small_star(above))


def test_a_giant_component_is_found(spark):
    hub = spark.range(1, 100_001).select(F.lit(200_000).cast("long").alias("a"), F.col("id").alias("b"))
    found = components.components(hub).groupBy("component").count().collect()
    assert [tuple(row) for row in found] == [(1, 100_001)]


def test_hot_host_is_split(spark, small_limits):
    hosts = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "big").otherwise(F.col("id").cast("string"))
    docs = spark.range(30_000).repartition(8).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"), hosts.alias("source"))
    assert "skew=true" in plan(quality_rules.host_rules(docs))


def test_hot_capture_is_split_and_rows_without_url_stay_out(spark, small_limits):
    urls = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "http://a.b/x").otherwise(F.concat(F.lit("http://c.d/"), "id"))
    captures = spark.range(60_000).repartition(8).select(F.col("id").alias("page_id"), urls.alias("url"), F.lit(5).cast("long").alias("fetched_at"))
    entries = spark.createDataFrame([("host:a.b", 1, True, 9)], "pattern string, at long, listed boolean, entry_id long")
    found = url_filters.filter_urls(captures, entries)
    assert "skew=true" in plan(found)
    assert found.where("blocked").count() == 20_000 and found.count() == 60_000


def test_hot_document_is_split(spark, small_limits):
    ids = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))
    docs = spark.range(30_000).repartition(8).select(ids.alias("doc_id"), F.concat(F.lit("a line of some length "), F.col("id") % 50).alias("text"))
    state = line_dedup.insert(line_dedup.empty_state(spark), docs)
    assert "skew=true" in plan(line_dedup.drop_repeated_lines(docs, state))
    assert ngram_join.keep_one(docs, 3, 90).where("doc_id is null").count() == 10_000


def test_long_histories_are_cut(spark, monkeypatch):
    """Segments of a pattern with gaps, one with a single entry, and bursts."""
    monkeypatch.setattr(url_filters, "PER_SEGMENT", 4)
    rows = [("host:a", at, at % 3 != 0, at) for at in [*range(40), *range(1000, 1010), 50_000]]
    rows += [("host:b", 7, True, 100), ("host:c", 1, True, 200), ("host:c", 9, False, 201)]
    entries = spark.createDataFrame(rows, "pattern string, at long, listed boolean, entry_id long")
    found = sorted(tuple(row) for row in url_filters.validity(entries).collect())
    times = sorted(at for name, at, _, _ in rows if name == "host:a")
    ends = dict(zip(times, [*times[1:], None]))
    expected = [("host:a", at, ends[at], at) for at in times if at % 3] + [("host:b", 7, None, 100), ("host:c", 1, 9, 200)]
    assert found == sorted(expected, key=lambda row: row[:2])


def test_captures_keep_columns_of_any_name(spark):
    rows = [(1, "http://a.b/x", 5, "kept", "kept", "kept"), (2, None, 5, "kept", "kept", "kept")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at long, n_ string, `_url` string, at_ string")
    entries = spark.createDataFrame([("host:a.b", 1, True, 9)], "pattern string, at long, listed boolean, entry_id long")
    found = url_filters.filter_urls(captures, entries)
    assert found.columns == [*captures.columns, "n_active", "first_entry", "blocked"]
    assert [tuple(row)[3:] for row in found.orderBy("page_id").collect()] == [("kept",) * 3 + (1, 9, True), ("kept",) * 3 + (0, None, False)]

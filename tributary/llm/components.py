"""Connected components of links between ids, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators.aggregates import collapse
from tributary.sources.scratch import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that occurs in ``links``; component is the smallest id.

    Alternating large-star and small-star steps: in each, every id points its larger (or
    smaller) neighbours to the smallest id it knows, until no link changes. The hub of a
    large component has a link to each of its ids. The smallest of a hub's neighbours is
    found in two steps, map-side and over all tasks, and its links to them are split among
    tasks by adaptive execution where they meet it: ``collapse`` keeps that possible. Each
    round takes the place of the one before in the shared folder. Null ids, and links of an
    id to itself, are left out.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    given = F.col(a).isNotNull() & F.col(b).isNotNull()
    edges = stored(edges.where(given & (F.col("u") != F.col("v"))).distinct(), "links")
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links", replaces=edges)
        facts = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if facts == seen:
            break
        seen = facts
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Point each id's larger neighbours to the smallest of the id and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = collapse(both, "u", m=F.min("v")).withColumn("m", F.least("m", "u"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
    return larger.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Point each id and its smaller neighbours to the smallest neighbour."""
    least = collapse(edges, "u", m=F.min("v"))
    joined = edges.join(least, "u")
    moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()

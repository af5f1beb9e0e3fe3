"""Centroid clustering against plain integer arithmetic and the expected result in SQL."""

import hashlib
import random

import duckdb
import pytest

from tests.llm.conftest import SMALL
from tributary.llm import centroid_clustering as clustering

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, clusters=16, rounds=3):
    """Every distance from the components, in Python integers."""
    kept = [(vec, [int((64 * x) // 1) for x in v]) for vec, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and abs(x) < 1e30 for x in v)]
    mark = lambda vec: hashlib.sha256(f"1:{vec}".encode()).hexdigest() if vec is not None else "~"
    centroids = [q for _, q in sorted(kept, key=lambda row: (mark(row[0]), row[1]))[:clusters]]
    for after in range(rounds + 1):
        placed = [min((sum((a - b) ** 2 for a, b in zip(q, c)), k) for k, c in enumerate(centroids)) for _, q in kept]
        if after == rounds:
            break
        for k in range(len(centroids)):
            own = [q for (_, q), (_, at) in zip(kept, placed) if at == k]
            if own:
                centroids[k] = [sum(column) // len(own) for column in zip(*own)]
    total = sum(d for d, _ in placed) if kept else 0
    out = []
    for (vec, _), (distance, k) in zip(kept, placed):
        digest = hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
        out.append((vec, k, distance, sum(d for d, at in placed if at == k), total, digest))
    return sorted(out, key=repr)


def found(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted((tuple(row) for row in clustering.query(spark, str(tmp_path)).collect()), key=repr)


def vector(choose, spread=1.0):
    return [choose.choice([-1, -0.5, 0, 0.25, 0.5, 1]) * spread for _ in range(64)]


def test_edge_rows(spark, tmp_path):
    choose = random.Random(2)
    rows = [(n, vector(choose), 0) for n in range(120)]
    rows += [(7, rows[7][1], 0)] * 60  # a vector that is a third of the table
    rows += [(None, vector(choose), 0), (500, None, 0), (501, [1.0] * 63, 0), (502, [], 0)]
    rows += [(503, [1.0] * 63 + [None], 0), (504, [1.0] * 63 + [float("nan")], 0), (505, [1.0] * 63 + [float("-inf")], 0)]
    rows += [(506, vector(choose, 9000.0), 0)]
    clash = [(*row, "x", 1, 2) for row in rows]
    assert found(spark, tmp_path, clash, SCHEMA + ", q string, cluster int, distance int") == brute(rows)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_fewer_vectors_than_clusters(spark, tmp_path, count):
    rows = [(n, vector(random.Random(n)), 0) for n in range(count)]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_products_are_updated_by_moved_components_only(spark):
    """The products after a round are exact, and unread components cannot change them."""
    rows = [(n, [n, -n, 3], None) for n in range(20)]
    vectors = spark.createDataFrame([row[:2] for row in rows], "vec_id long, q array<int>")
    before, after = [[1, 2, 3], [4, 5, 6]], [[1, 2, 3], [4, 9, 6]]
    state = clustering.update(vectors, None, before)
    # Where no component of the first two places moves, they are not looked at.
    blind = state.selectExpr("vec_id", "array(-1, q[1], -1) AS q", "dots")
    for row in clustering.update(blind, before, after).collect():
        q = rows[row["vec_id"]][1]
        assert list(row["dots"]) == [sum(a * b for a, b in zip(q, c)) for c in after]


def test_given_table_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as from '{SMALL}/embeddings.parquet'")
    result = connection.execute(clustering.ORACLE_SQL)
    names = [column[0] for column in result.description]
    rows = clustering.query(spark, SMALL).select(*names).collect()
    assert sorted(tuple(row) for row in rows) == sorted(result.fetchall())

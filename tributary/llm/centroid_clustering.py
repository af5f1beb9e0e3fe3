"""Centroid clustering over an incremental matrix of exact dot products.

Vectors are turned into integers once. Each vector keeps its dot product with every
centroid. When centroids move, a product changes by the moved components alone, so a round
adds ``change[j] * x[j]`` for the components j that differ from the round before, and
takes the nearest centroid from the products again. All numbers are integers, so the
clusters do not depend on how the rows are stored or in which order they are added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.sources.scratch import stored

SIZE = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
#: Integers beyond this have squared distances that a long cannot hold.
LIMIT = 1 << 27
STATE = "vec_id long, q array<int>, dots array<long>, cluster int, distance long"

Centroids = list[list[int]]


def integer_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE, scale: int = SCALE
) -> DataFrame:
    """(vec_id, q): vectors of ``size`` finite components as integers floor(scale * x).

    Null vectors, other lengths, null and non-finite components are left out, and so are
    components beyond ``LIMIT`` (two million at a scale of 64), whose distances no long
    can hold. Other columns are not read.
    """
    scaled = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    # NaN is larger than every number, so the comparison rejects it as well.
    fits = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < LIMIT))
    kept = vectors.where((F.size(vector_col) == size) & fits)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), scaled.cast("array<int>").alias("q"))


def first_centroids(integers: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> Centroids:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``, in that order.

    Equal ids are ordered by their components; null ids come last. At most ``clusters``
    rows reach the driver, and no task keeps more.
    """
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = integers.select("q", mark.alias("mark")).orderBy(F.asc_nulls_last("mark"), "q").limit(clusters)
    return [list(row["q"]) for row in rows.collect()]


def update(state: DataFrame, before: Centroids | None, after: Centroids) -> DataFrame:
    """The state for the centroids ``after``, from vectors or from the state for ``before``.

    Only components that differ between the two are read from a vector. The nearest
    centroid has the smallest squared distance, and the smallest number among equals.
    """
    new = np.array(after, np.int64)
    change = new if before is None else new - np.array(before, np.int64)
    moved = [np.flatnonzero(row) for row in change]
    squares = (new * new).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("q"), new.shape[1])
            if before is None:
                dots = np.zeros((len(q), len(new)), np.int64)
            else:
                dots = _matrix(batch.column("dots"), len(new)).copy()
            for k, places in enumerate(moved):
                if len(places):
                    dots[:, k] += q[:, places] @ change[k, places]
            distances = (q * q).sum(1)[:, None] - 2 * dots + squares
            nearest = distances.argmin(1)  # the first of equal ones
            least = distances[np.arange(len(q)), nearest]
            arrays = [batch.column("vec_id"), batch.column("q"), _lists(dots), pa.array(nearest.astype(np.int32)), pa.array(least)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "q", "dots", "cluster", "distance"])

    return state.mapInArrow(run, STATE)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width).astype(np.int64, copy=False)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def moved_centroids(state: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid as the floored mean of its vectors; one without vectors stays.

    Sums are combined map-side, so a cluster that holds most vectors is one row a task.
    The driver gets a row per centroid and divides there, since a double is not exact.
    """
    width = len(centroids[0])
    sums = [F.sum(F.col("q")[j].cast("long")).alias(f"s{j}") for j in range(width)]
    totals = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums)
    moved = [list(centroid) for centroid in centroids]
    for row in totals.collect():
        moved[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(width)]
    return moved


def cluster_vectors(integers: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, Centroids]:
    """The last state, (vec_id, q, dots, cluster, distance), and the final centroids.

    Every row is clustered, repeated ones too. The state of a round is stored in the shared
    folder, and takes the place of the one before. With fewer vectors than clusters there
    are as many centroids as vectors; without vectors the state is empty.
    """
    centroids = first_centroids(integers, clusters, seed)
    if not centroids:
        return integers.sparkSession.createDataFrame([], STATE), []
    state = stored(update(integers, None, centroids), "clusters")
    for _ in range(rounds):
        after = moved_centroids(state, centroids)
        state = stored(update(state, centroids, after), "clusters", replaces=state)
        centroids = after
    return state, centroids


def report(state: DataFrame, centroids: Centroids) -> DataFrame:
    """A row per vector with its cluster's and the table's inertia and its centroid's digest.

    What is attached to the rows are three lists with an entry per centroid. An inertia
    that a long cannot hold is null.
    """
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    found = {row["cluster"]: int(row["total"]) for row in state.groupBy("cluster").agg(total.alias("total")).collect()}
    inertias = [_long(found.get(k, 0)) for k in range(len(centroids))]
    digests = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids]
    number = F.col("cluster")
    return state.select(
        "vec_id",
        "cluster",
        "distance",
        _pick(inertias, number, "long").alias("cluster_inertia"),
        _long(sum(found.values())).alias("inertia"),
        _pick(digests, number, "string").alias("centroid_sha256"),
    )


def _long(number: int) -> Column:
    return F.lit(number if number < 1 << 63 else None).cast("long")


def _pick(values: list[Column], number: Column, kind: str) -> Column:
    return F.get(F.array(*values).cast(f"array<{kind}>"), number)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of the table in sixteen clusters after three rounds."""
    integers = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return report(*cluster_vectors(integers))


def _oracle() -> str:
    """Rounds as nested queries, with every distance from the components."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {SIZE}
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY mark NULLS LAST, q) - 1 AS k, q AS c
  FROM (SELECT q, sha256('{SEED}:' || vec_id) AS mark FROM kept ORDER BY mark NULLS LAST, q LIMIT {CLUSTERS})
)""",
    ]
    square = "list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(q) AS q,
         min(struct_pack(d := CAST({square} AS BIGINT), k := k)) AS best
  FROM kept, c{r} GROUP BY rid
)"""
        )
        if r < ROUNDS:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT k, coalesce(moved, c) AS c FROM c{r} LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS moved FROM (
      SELECT best.k AS k, j, CAST(sum(q[j]) AS BIGINT) AS s, count(*) AS n
      FROM a{r}, (SELECT unnest(range(1, {SIZE + 1})) AS j) GROUP BY ALL
    ) GROUP BY k
  ) USING (k)
)"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON best.k = c{ROUNDS}.k
"""


ORACLE_SQL = _oracle()

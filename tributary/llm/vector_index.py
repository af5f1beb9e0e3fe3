"""Near-duplicate embeddings through an inverted multi-index.

Unit vectors are cut into halves, each half has its own codebook, and a vector's cell is
the pair of its nearest codewords. A vector visits cells in the order of its distance to
them, found by multi-sequence traversal, up to a distance calibrated for the target
recall; every vector in a visited cell is then compared exactly.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.llm.components import components
from tributary.llm.ngram_join import forest
from tributary.llm.sampling import hashed_sample
from tributary.sources.scratch import stored

MIN_COSINE = 0.95
TARGET_RECALL = 0.999
#: Bound of the sample the codebooks are fitted on, by hash of the vector.
SAMPLE = 8_192
#: Vectors per cell to aim at, and a bound on the codewords of a half, which the sample has
#: to support and whose square bounds the table of cell sizes.
PER_CELL, MAX_CODEWORDS = 64, 512
ROUNDS = 15
LINKS = "key binary, links long, other binary"
#: Vectors of a cell, and visitors of it, that are compared in one task.
TILE = 1_000


@dataclass(frozen=True)
class MultiIndex:
    """Two codebooks and the squared distance up to which cells are visited."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves of unit vectors to the codewords of each."""
        half = self.first.shape[1]
        return _squared(vectors[:, :half], self.first), _squared(vectors[:, half:], self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self.distances(vectors)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def visits(self, vectors: np.ndarray) -> list[list[int]]:
        """The cells each vector visits, nearest first."""
        a, b = self.distances(vectors)
        return [list(traverse(x, y, self.reach)) for x, y in zip(a, b)]

    def visited(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether vector i visits cell i."""
        a, b = self.distances(vectors)
        rows, width = np.arange(len(vectors)), len(self.second)
        nearest = (a.argmin(1) * width + b.argmin(1)) == cells
        return nearest | (a[rows, cells // width] + b[rows, cells % width] <= self.reach)


def _squared(x: np.ndarray, codewords: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ codewords.T + (codewords**2).sum(1)[None, :], 0)


def traverse(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[int]:
    """Cells by increasing sum of the two distances, the nearest in any case.

    Both lists are sorted; a heap holds the frontier of the grid, as in the multi-sequence
    algorithm.
    """
    i_order, j_order = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[i_order], second[j_order]
    heap, seen = [(a[0] + b[0], 0, 0)], {(0, 0)}
    start = True
    while heap:
        distance, i, j = heapq.heappop(heap)
        if distance > reach and not start:
            return
        start = False
        yield int(i_order[i]) * len(second) + int(j_order[j])
        for step in ((i + 1, j), (i, j + 1)):
            if step[0] < len(a) and step[1] < len(b) and step not in seen:
                seen.add(step)
                heapq.heappush(heap, (a[step[0]] + b[step[1]], *step))


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from distinct rows; a codeword without rows stays where it is."""
    rows = np.unique(rows, axis=0)
    centres = rows[rng.permutation(len(rows))[:k]]
    for _ in range(ROUNDS):
        near = _squared(rows, centres).argmin(1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def fit_index(sample: np.ndarray, min_cosine: float = MIN_COSINE, recall: float = TARGET_RECALL, codewords: int = 32, seed: int = 0) -> MultiIndex:
    """Codebooks of unit vectors, and a reach under which the target recall is met.

    A pair is found if either of its vectors visits the other's cell, so what counts is the
    smaller of the two distances. The reach is its given quantile: over all linked pairs in
    the sample, and over partners made at exactly the cosine bound in random directions,
    which are the hardest to reach.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    half = max(1, dim // 2)
    first = _kmeans(sample[:, :half], codewords, rng)
    second = _kmeans(sample[:, half:], codewords, rng) if dim > half else np.zeros((1, 0))
    index = MultiIndex(first, second, 0.0)
    noise = rng.normal(size=sample.shape)
    noise -= (noise * sample).sum(1)[:, None] * sample
    size = np.linalg.norm(noise, axis=1, keepdims=True)
    edge = min_cosine * sample + np.sqrt(max(0.0, 1 - min_cosine**2)) * noise / np.maximum(size, 1e-12)
    reach = linked_reach(index, sample, min_cosine, recall)
    if len(sample):
        away = np.minimum(_away(index, sample, index.cells(edge)), _away(index, edge, index.cells(sample)))
        reach = max(reach, float(np.quantile(away, recall)))
    return MultiIndex(first, second, reach + 1e-9)


def _away(index: MultiIndex, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The squared distance of vector i to cell i."""
    a, b = index.distances(vectors)
    rows, width = np.arange(len(vectors)), len(index.second)
    return a[rows, cells // width] + b[rows, cells % width]


def linked_reach(index: MultiIndex, sample: np.ndarray, min_cosine: float, recall: float) -> float:
    """The quantile of the smaller distance between sample vectors and the cells of those linked to them.

    All linked pairs of the first 2048 vectors with the sample count, in blocks of 512
    vectors, of which the farthest reach is taken. A pair weighs one over the pairs of its
    vector, so that a large group of near-copies does not outweigh small ones.
    """
    own, width, reach = index.cells(sample), len(index.second), 0.0
    every = index.distances(sample)
    for begin in range(0, min(len(sample), 2_048), 512):
        block = sample[begin : begin + 512]
        near = block @ sample.T >= min_cosine
        near[np.arange(len(block)), np.arange(len(block)) + begin] = False
        x, y = np.nonzero(near)
        if len(x):
            ways = [every[0][i, own[j] // width] + every[1][i, own[j] % width] for i, j in ((x + begin, y), (y, x + begin))]
            away = np.minimum(*ways)
            order = np.argsort(away)
            weight = np.cumsum((1 / near.sum(1)[x])[order])
            place = np.searchsorted(weight, recall * weight[-1])
            reach = max(reach, float(away[order[min(place, len(order) - 1)]]))
    return reach


def unit_vectors(binary: list[bytes], kind: str = "<f8") -> np.ndarray:
    """Vectors kept as bytes, in double precision and of length one."""
    rows = np.array([np.frombuffer(x, kind) for x in binary], np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE, recall: float = TARGET_RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing. Vectors of different lengths do not link either; each length that two or more
    distinct vectors have gets an index of its own, one after the other. Equal vectors are
    one class, which is compared once and counts as often as it occurs. A pair counts for
    both sides if either visits the other's cell; none below the bound counts. Rows
    without an id are counted as links of others but have no component of their own name
    unless their class has an id. Every row stays, repeated ones too.

    Cells are cut into tiles of vectors and visitors by hash, so that no cell, however
    large, is one task's work, and a tile returns counts and a spanning forest, never its
    pairs.
    """
    spark = vectors.sparkSession
    value = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), value.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.col("v")))
    rows = rows.withColumn("key", F.when(F.col("v").isNotNull(), F.unhex(F.sha2(F.to_json(F.struct("v")), 256))))
    # Vectors of single precision travel as such, which loses nothing and halves the visits.
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    classes = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"), F.any_value("v").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch["v"]).to_numpy(zero_copy_only=False)
            values = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(kind)
            raw = [row.tobytes() for row in np.split(values, np.cumsum(lengths)[:-1])] if len(lengths) else []
            arrays = [batch["key"], batch["rep"], batch["m"], pa.array(lengths.astype(np.int32)), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "rep", "m", "d", "v"])

    classes = stored(classes.select("key", "rep", "m", "v").mapInArrow(pack, "key binary, rep long, m long, d int, v binary"), "vectors")
    found = spark.createDataFrame([], LINKS)
    # One row per length that occurs more than once.
    for length in classes.groupBy("d").count().where("count > 1").orderBy("d").collect():
        own = classes.where(F.col("d") == length.d)
        sample = hashed_sample(own.select("key", "v"), SAMPLE, "key")
        size = max(4, round(math.sqrt(length["count"] / PER_CELL)))
        fitted = fit_index(unit_vectors([r.v for r in sample], kind), min_cosine, recall, min(size, MAX_CODEWORDS))
        index = spark.sparkContext.broadcast(fitted)
        found = found.unionByName(stored(_compare(own, index, min_cosine, kind), "near"))
    # Links are between the smallest ids of classes; those without any take no part in them.
    ids = classes.where("rep is not null").select("key", "rep")
    a, b = ids.select("key", F.col("rep").alias("a")), ids.select(F.col("key").alias("other"), F.col("rep").alias("b"))
    links = found.where("other is not null").join(a, "key").join(b, "other").select("a", "b")
    linked = components(links)
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = classes.select("key", "rep", "m").join(counts, "key", "left").join(linked, F.col("rep") == F.col("id"), "left")
    named = named.select(
        "key",
        (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    out = rows.select("vec_id", "key").join(named, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _compare(classes: DataFrame, index, min_cosine: float, kind: str) -> DataFrame:
    """(key, links, other): partial counts of linked vectors, and forest links to ``other``."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = index.value.cells(unit_vectors(batch["v"].to_pylist(), kind))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], names=["key", "m", "v", "cell"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1_000):
                part = batch.slice(first, 1_000)
                visits = index.value.visits(unit_vectors(part["v"].to_pylist(), kind))
                rows = pa.array(np.repeat(np.arange(len(visits)), [len(v) for v in visits]))
                cells = pa.array(np.concatenate(visits).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.take(rows).columns, cells], names=["key", "m", "v", "home", "cell"])

    schema = "key binary, m long, v binary, cell int"
    placed = stored(classes.select("key", "m", "v").mapInArrow(place, schema), "placed")
    visits = stored(placed.withColumnRenamed("cell", "home").mapInArrow(visit, "key binary, m long, v binary, home int, cell int"), "visits")

    def parts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias(name))

    # One row per cell, of which there are MAX_CODEWORDS squared at most.
    sizes = F.broadcast(parts(placed, "n_own").join(parts(visits, "n_seen"), "cell"))
    part = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = placed.join(sizes, "cell").select("cell", part("n_own").alias("p"), every("n_seen").alias("q"), "key", "m", "v")
    seen = visits.join(sizes, "cell").select("cell", every("n_own").alias("p"), part("n_seen").alias("q"), "key", "m", "v", "home")

    def tile(key, own: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(seen):
            return pd.DataFrame({"key": [], "links": [], "other": []})
        x, y = unit_vectors(list(own["v"]), kind), unit_vectors(list(seen["v"]), kind)
        near = x @ y.T >= min_cosine
        xk, yk = own["key"].to_numpy(object), seen["key"].to_numpy(object)
        i, j = np.nonzero(near)
        apart = xk[i] != yk[j]
        i, j = i[apart], j[apart]
        xm, ym = own["m"].to_numpy(np.int64), seen["m"].to_numpy(np.int64)
        # The visitor counts the one it found; that one counts the visitor here only if it
        # does not find it itself when it visits the visitor's cell.
        alone = ~index.value.visited(x[i], seen["home"].to_numpy(np.int64)[j]) if len(i) else np.zeros(0, bool)
        counts = pd.concat(
            [
                pd.DataFrame({"key": yk[j], "links": xm[i]}),
                pd.DataFrame({"key": xk[i[alone]], "links": ym[j[alone]]}),
            ]
        ).groupby("key", as_index=False)["links"].sum()
        names, number = np.unique(np.concatenate([xk, yk]), return_inverse=True)
        linked = np.zeros((len(names), len(names)), bool)
        linked[number[: len(xk)][i], number[len(xk) :][j]] = True
        tree = pd.DataFrame(forest(linked, np.arange(len(names))), columns=["a", "b"], dtype=np.int64)
        edges = pd.DataFrame({"key": names[tree["a"]], "links": 0, "other": names[tree["b"]]})
        return pd.concat([counts.assign(other=None), edges])[["key", "links", "other"]]

    groups = own.groupBy("cell", "p", "q").cogroup(seen.groupBy("cell", "p", "q"))
    return groups.applyInPandas(tile, LINKS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, linked from a cosine of 0.95 on."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

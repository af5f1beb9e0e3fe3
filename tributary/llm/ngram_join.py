"""Near-copies by word n-grams: a blocked sparse product of the document by n-gram matrix.

Documents with equal n-gram sets are one class from the start. Two classes can only be
linked if they share one of the rarest n-grams of each (their prefix, whose length follows
from the set's size), so the matrix is cut into blocks of classes that share prefix
columns. Pairs are first screened by size alone: by the sizes of the two sets, and by how
many n-grams of each fall into each of a few classes of hashes, since the overlap cannot
be more than the sum of the smaller counts. For what is left of a block, the product of
the incidence matrix with its transpose is summed over column blocks, and the sum stops
when no pair can still reach the bound its sizes set. Most blocks are small, so a task screens
the pairs of many at once, PAIRS at a time. A block returns a spanning forest of
its links, not its pairs, so a large group of near-copies stays linear in what it writes.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.llm.components import components
from tributary.llm.names import quoted, unused
from tributary.llm.words import Words, ngrams, text_slices
from tributary.sources.scratch import stored

#: Counters of n-gram frequency: 2**SKETCH_BITS, whatever the corpus. They travel in parts
#: of 2**PART_BITS.
SKETCH_BITS, PART_BITS = 20, 12
#: Bounds of a tile of a block: classes, and n-grams in their sets.
TILE_DOCS = 1_000
TILE_GRAMS = 2_000_000
#: Pairs of classes, ordered ones, that one task screens on average, and the least number
#: of tasks they are dealt to.
TASK_PAIRS, MIN_TASKS = 20_000, 256
#: Columns that are multiplied at once, rows whose bounds are held at once, and pairs of
#: sets that are screened at once.
COLUMNS, ROWS, PAIRS = 512, 128, 1 << 15
#: Hash classes whose sizes screen pairs: for all sets, and for sets of MANY n-grams or more.
MANY = 1_024
COARSE, FINE = 64, 512


def gram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    for _, _, offsets, data in text_slices(texts):
        words = Words(offsets, data)
        hashes = words.hashes(lower=True)
        windows = ngrams(hashes, n)  # also those across two texts, which none of them takes
        for first, after in itertools.pairwise(words.bounds.tolist()):
            own = np.sort(windows[first : after - n + 1] if after - first >= n else ngrams(hashes[first:after], n))
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            yield own[new]


def _set_key(grams: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def shape_of(grams: np.ndarray) -> bytes:
    """How many n-grams fall into each hash class; FINE classes for large sets."""
    classes = (grams & np.uint64(FINE - 1)).astype(np.int64)
    if len(grams) < MANY:
        classes //= FINE // COARSE
    counts = np.bincount(classes, minlength=COARSE if len(grams) < MANY else FINE)
    return _narrow(counts)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in the least width that holds them."""
    most = int(counts.max(initial=0))
    return counts.astype(next(f"<u{size}" for size in (1, 2, 4, 8) if most < 1 << 8 * size)).tobytes()


def _shapes(raw: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The COARSE counts of all sets, the FINE ones of the large, and where in these each set is."""
    _, offsets, data = raw.buffers()
    offsets = np.frombuffer(offsets, np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    many = sizes >= MANY
    lengths, classes = np.diff(offsets), np.where(many, FINE, COARSE)
    coarse = np.zeros((len(raw), COARSE), np.int32)
    fine, at = np.zeros((int(many.sum()), FINE), np.int32), np.cumsum(many) - 1
    for length in np.unique(lengths):
        for held in (COARSE, FINE):
            rows = np.flatnonzero((lengths == length) & (classes == held))
            if len(rows):
                own = np.ascontiguousarray(data[offsets[rows][:, None] + np.arange(length)])
                counts = own.view(f"<u{length // held}").astype(np.int32)
                coarse[rows] = counts.reshape(len(rows), COARSE, -1).sum(2)
                if held == FINE:
                    fine[at[rows]] = counts
    return coarse, fine, at


def candidates(raw: pa.Array, sizes: np.ndarray, starts: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets of one tile that may be linked, lower row first: all that are, and few more.

    ``starts`` are the first rows of the tiles, which are screened side by side. Pairs
    leave in the order of their lower rows, PAIRS or those of one row at a time.
    """
    coarse, fine, at = _shapes(raw, sizes)
    ends = np.repeat(np.append(starts[1:], len(sizes)), np.diff(np.append(starts, len(sizes))))
    others = ends - np.arange(len(sizes)) - 1
    before = np.concatenate(([0], np.cumsum(others)))
    first = 0
    while first < len(sizes):
        after = max(first + 1, int(np.searchsorted(before, before[first] + PAIRS, "right")) - 1)
        own = np.arange(first, after)
        i = np.repeat(own, others[own])
        j = i + 1 + np.arange(len(i)) - (before[i] - before[first])
        first = after
        fits = np.minimum(sizes[i], sizes[j]) * (100 + percent) >= percent * (sizes[i] + sizes[j])
        i, j = i[fits], j[fits]
        fits = np.minimum(coarse[i], coarse[j]).sum(1) * (100 + percent) >= percent * (sizes[i] + sizes[j])
        i, j = i[fits], j[fits]
        large = np.flatnonzero((sizes[i] >= MANY) & (sizes[j] >= MANY))
        fits = np.ones(len(i), bool)
        step = max(1, PAIRS * COARSE // FINE)
        for part in range(0, len(large), step):
            x = large[part : part + step]
            most = np.minimum(fine[at[i[x]]], fine[at[j[x]]]).sum(1)
            fits[x] = most * (100 + percent) >= percent * (sizes[i[x]] + sizes[j[x]])
        if fits.any():
            yield i[fits], j[fits]


def screen(raw: list[bytes], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets of one tile may be linked, as an upper triangle."""
    maybe = np.zeros((len(sizes), len(sizes)), bool)
    for i, j in candidates(pa.array(raw, pa.binary()), np.asarray(sizes, np.int64), np.zeros(1, np.int64), percent):
        maybe[i, j] = True
    return maybe


def whole_tiles(batches: Iterator[pa.RecordBatch], tile: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole tiles, and the first row of each; rows come sorted by tile."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            rows, batch = held, held
        elif not len(batch):
            continue
        else:
            rows = batch if held is None else pa.concat_batches([held, batch])
        if rows is None:
            return
        new = np.zeros(len(rows), bool)
        new[0] = True
        for name in tile:
            key = rows[name].to_numpy(zero_copy_only=False)
            new[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        if rows is held:  # the last
            yield rows, starts
        else:
            if len(starts) > 1:
                yield rows.slice(0, starts[-1]), starts[:-1]
            held = rows.slice(starts[-1])


def frequency_sketch(texts: DataFrame, n: int) -> np.ndarray:
    """How many n-grams of all texts fall on each counter.

    A passage that many documents share stands out whatever else falls on its counter.
    The counts only order columns; any order gives the same links.
    """

    parts, part = 1 << SKETCH_BITS - PART_BITS, 1 << PART_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for grams in gram_sets(batch["text"], n):
                np.add.at(total, _bucket(grams), 1)
        counts = [_narrow(own) for own in total.reshape(parts, part)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts)), pa.array(counts, pa.binary())], names=["part", "counts"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(part, np.int64)
        for batch in batches:
            for counts in batch["counts"]:
                held = counts.as_buffer()
                total += np.frombuffer(held, f"<u{held.size // part}")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([_narrow(total)], pa.binary())], names=["part", "counts"])

    found = texts.select("text").mapInArrow(count, "part long, counts binary")
    sketch = np.zeros((parts, part), np.int64)
    for row in found.groupBy("part").applyInArrow(add, found.schema).collect():  # a row per part
        sketch[row.part] = np.frombuffer(row.counts, f"<u{len(row.counts) // part}")
    sketch = sketch.ravel()
    return sketch.astype(np.uint32) if sketch.max() < 1 << 32 else sketch


def prefix_size(size: int, percent: int) -> int:
    """Columns of which linked sets share one: a link needs percent % of the set in common."""
    return size - -(-percent * size // 100) + 1


def prefix_of(grams: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest of a set's sorted n-grams; of equally rare ones the smallest."""
    size = prefix_size(len(grams), percent)
    bound = np.partition(counts, size - 1)[size - 1]
    below = np.flatnonzero(counts < bound)
    return grams[np.concatenate((below, np.flatnonzero(counts == bound)[: size - len(below)]))]


def document_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, prefix, shape) of each row of (doc_id, text)."""
    sketch = docs.sparkSession.sparkContext.broadcast(frequency_sketch(docs, n))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, prefixes, ends, shapes = [], [], [np.empty(0, np.uint64)], [0], []
            for grams in gram_sets(batch["text"], n):
                sizes.append(len(grams))
                keys.append(_set_key(grams))
                shapes.append(shape_of(grams))
                if len(grams):
                    prefixes.append(prefix_of(grams, sketch.value[_bucket(grams)], percent))
                ends.append(ends[-1] + (len(prefixes[-1]) if len(grams) else 0))
            flat = pa.array(np.concatenate(prefixes).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            arrays = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists, pa.array(shapes, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "set_key", "prefix", "shape"])

    return docs.mapInArrow(build, "doc_id long, n_shingles long, set_key binary, prefix array<long>, shape binary")


def size_band(percent: int) -> Column:
    """The band of a set of ``n`` n-grams; linked sets are in the same or the next band."""
    width = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9
    return F.floor(F.log("n") / width).cast("long")


def blocks(classes: DataFrame, percent: int) -> DataFrame:
    """(block, rep): which classes meet where, such that any two that may be linked do.

    A column is an n-gram and a band of sizes; it holds the classes of that band and the
    one below, and at least one of that band. A class's home is the most frequent of its
    shared columns, so a group of near-copies has few homes. A class also visits the homes
    of others it shares a column with, if they come after its own.
    """
    cells = classes.select("rep", "n", F.explode("prefix").alias("gram"))
    frequent = cells.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("gram")
    banded = cells.join(frequent, "gram").withColumn("band", size_band(percent))
    above = F.explode(F.array(F.lit(0), F.lit(1))).alias("above")
    columns = banded.select("rep", "gram", "band", above).select("rep", F.xxhash64("gram", F.col("band") + F.col("above")).alias("gram"), "above")
    columns = stored(columns, "columns")
    counted = columns.groupBy("gram").agg(F.count(F.lit(1)).alias("df"), F.min("above").alias("above"))
    counted = counted.where("df > 1 and above = 0").select("gram", "df")
    shared = stored(columns.select("rep", "gram").join(counted, "gram"), "cells")
    homes = shared.groupBy("rep").agg(F.max(F.struct("df", "gram"))["gram"].alias("home"))
    placed = stored(shared.select("rep", "gram").join(homes, "rep"), "placed")
    found = placed.select("gram", F.col("home").alias("block")).distinct()
    visits = placed.join(found, "gram").where("block > home").select("block", "rep")
    return visits.unionByName(homes.select(F.col("home").alias("block"), "rep")).distinct()


def tiles(members: DataFrame, percent: int) -> DataFrame:
    """(tile columns, rep): blocks as they are, large ones cut into pairs of parts.

    A large block is cut by bands of set size, within which sizes differ by the bound at
    most, and each band into parts of bounded size by hash. Only parts of equal or
    neighbouring bands are paired. Single classes need no tile.
    """
    banded = members.withColumn("band", size_band(percent))

    def parts(count: str, grams: str) -> Column:
        return F.ceil(F.greatest(F.col(count) / TILE_DOCS, F.col(grams) / TILE_GRAMS)).cast("int")

    bands = banded.groupBy("block", "band").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("g"))
    totals = bands.groupBy("block").agg(F.sum("k").alias("k"), F.sum("g").alias("g")).where("k > 1")
    whole = totals.where(parts("k", "g") == 1).select("block")
    large = totals.where(parts("k", "g") > 1).select("block")
    none = F.lit(0)
    plain = banded.join(whole, "block").select(
        "block", *[none.cast(t).alias(c) for c, t in (("low", "long"), ("low_part", "int"), ("high", "long"), ("high_part", "int"))], "rep"
    )
    cut = bands.join(large, "block").select("block", "band", parts("k", "g").alias("parts"))
    own = banded.join(cut, ["block", "band"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).drop("parts")
    near = own.withColumn("other", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    others = cut.select("block", F.col("band").alias("other"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other_part"))
    met = near.join(others, ["block", "other"])
    first = (F.col("band") < F.col("other")) | ((F.col("band") == F.col("other")) & (F.col("part") <= F.col("other_part")))
    pairs = met.select(
        "block",
        F.when(first, F.col("band")).otherwise(F.col("other")).alias("low"),
        F.when(first, F.col("part")).otherwise(F.col("other_part")).alias("low_part"),
        F.when(first, F.col("other")).otherwise(F.col("band")).alias("high"),
        F.when(first, F.col("other_part")).otherwise(F.col("part")).alias("high_part"),
        "rep",
    )
    return plain.unionByName(pairs)


def overlaps(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets are linked, by the product of their incidence matrix.

    Columns held by many sets are multiplied as dense blocks, those held by few are added
    pair by pair. Before each dense block, pairs that cannot reach their bound with all
    that is left are discarded; if none remains, the rest of the product is not computed.
    """
    k = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if k == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[False, shared * (100 + percent) >= percent * sizes.sum()], [False, False]])
    total = np.zeros((k, k), np.float32)
    open_ = np.triu(np.ones((k, k), bool), 1)

    def bounded(left: np.ndarray) -> None:
        """Discard the pairs that cannot reach their bound with ``left`` more in either set."""
        for first in range(0, k, ROWS):
            own = slice(first, first + ROWS)
            most = total[own, first:].astype(np.int64) + np.minimum(left[own, None], left[None, first:])
            open_[own, first:] &= most * (100 + percent) >= percent * (sizes[own, None] + sizes[None, first:])

    bounded(sizes)
    owner = np.repeat(np.arange(k, dtype=np.int32), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    begin = np.concatenate(([0], np.cumsum(count)))
    members = owner[order].astype(np.int64)
    many = max(8, k // 16)
    flat = total.ravel()
    for held in np.unique(count[(count > 1) & (count < many)]):
        a, b = np.triu_indices(held, 1)
        chosen = np.flatnonzero(count == held)
        step = max(1, 250_000 // len(a))
        for first in range(0, len(chosen), step):
            rows = members[begin[chosen[first : first + step]][:, None] + np.arange(held)]
            np.add.at(flat, (rows[:, a] * k + rows[:, b]).ravel(), 1)
    dense = np.flatnonzero(count >= many)
    left = np.bincount(owner[count[column] >= many], minlength=k)
    for first in range(0, len(dense), COLUMNS):
        bounded(left)
        if not open_.any():
            return open_
        own = dense[first : first + COLUMNS]
        cells = np.concatenate([np.arange(begin[c], begin[c + 1]) for c in own])
        block = np.zeros((k, len(own)), np.float32)
        block[members[cells], np.repeat(np.arange(len(own)), count[own])] = 1
        for row in range(0, k, ROWS):
            total[row : row + ROWS, row:] += block[row : row + ROWS] @ block[row:].T
        left -= block.sum(1).astype(np.int64)
    bounded(np.zeros(k, np.int64))
    return open_


def forest(linked: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """(id, root) of every id that is not its component's first; ``linked`` is upper-triangular."""
    both = linked | linked.T
    free = np.ones(len(ids), bool)
    out = []
    for root in range(len(ids)):
        if not free[root]:
            continue
        free[root] = False
        front = np.array([root])
        while len(front):
            reached = both[front].any(0) & free
            free &= ~reached
            front = np.flatnonzero(reached)
            out += [(int(ids[i]), int(ids[root])) for i in front]
    return out


def screened(raw: pa.Array, sizes: np.ndarray, starts: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, roots) of the sets that may be linked to another of their tile, by component.

    ``starts`` are the first rows of the tiles.
    """
    tile, rows, roots = -1, [], []
    ends = np.append(starts[1:], len(sizes))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def close() -> None:
        if found:
            i, j = (np.concatenate(x) - starts[tile] for x in zip(*found))
            maybe = np.zeros((ends[tile] - starts[tile],) * 2, bool)
            maybe[i, j] = True
            held = np.unique(np.concatenate((i, j)))
            tree = forest(maybe[np.ix_(held, held)], held + starts[tile])
            parts = dict(tree) | {root: root for _, root in tree}
            rows.extend(parts)
            roots.extend(parts.values())
            found.clear()

    for i, j in candidates(raw, sizes, starts, percent):
        of = np.searchsorted(starts, i, "right") - 1
        cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
        for x, y in zip([0, *cuts], [*cuts, len(of)]):
            if of[x] != tile:
                close()
                tile = of[x]
            found.append((i[x:y], j[x:y]))
        if len(rows) > PAIRS:
            yield np.array(rows, np.int64), np.array(roots, np.int64)
            rows.clear(), roots.clear()
    close()
    if rows:
        yield np.array(rows, np.int64), np.array(roots, np.int64)


def ngram_components(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row.

    Words are runs other than ASCII white space, with A-Z lower-cased; a set holds the
    distinct windows of ``n`` words, or the whole sequence if it is shorter. Two documents
    are linked when their intersection is at least ``percent`` % of their union; a
    component is named by its smallest doc_id. Null and empty texts have no set and no
    links. Rows of one id are one document in that their links name it; a row without an
    id keeps its size and gets the component its text belongs to, null if only such rows
    hold that text. Every row stays; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = stored(document_sets(rows, n, percent), "sets")
    classes = sets.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("prefix").alias("prefix"), F.any_value("shape").alias("shape")
    )
    classes = stored(classes.where("rep is not null"), "classes")
    sized = classes.select("rep", "n")
    members = stored(blocks(classes, percent).join(sized, "rep"), "members")
    tile = ["block", "low", "low_part", "high", "high_part"]
    cut = stored(tiles(members, percent), "cut")
    # Tiles are dealt out by their pairs, not by their bytes: a tile's work is the square of
    # its rows. The number of tasks is given, so that adaptive execution leaves it alone.
    pairs = cut.groupBy(*tile).count().agg(F.sum(F.col("count").cast("double") ** 2)).first()[0] or 0
    tasks = max(MIN_TASKS, math.ceil(pairs / TASK_PAIRS))
    met = cut.join(classes.select("rep", "n", "set_key", "shape"), "rep").repartition(tasks, *tile)

    # Most tiles have a few rows, so a task screens many of them at once.
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_tiles(batches, tile):
            reps, sizes = (rows[name].to_numpy() for name in ("rep", "n"))
            for chosen, roots in screened(rows["shape"], sizes, starts, percent):
                found = rows.take(pa.array(chosen))
                yield pa.RecordBatch.from_arrays(
                    [*(found[name] for name in tile), pa.array(reps[roots]), found["rep"], found["set_key"]], names=[*tile, "part", "rep", "set_key"]
                )

    placed = met.select(*tile, "rep", "n", "set_key", "shape").sortWithinPartitions(*tile).mapInArrow(
        meet, "block long, low long, low_part int, high long, high_part int, part long, rep long, set_key binary"
    )
    placed = stored(placed, "tiles")

    # Only classes that may be linked need their whole sets, which are made from the text again.
    wanted = placed.select("rep", "set_key").distinct()
    texts = rows.join(wanted, F.col("doc_id") == F.col("rep")).select("rep", "set_key", "text")

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(gram_sets(batch["text"], n))
            same = pa.array([_set_key(grams) == key for grams, key in zip(made, batch["set_key"].to_pylist())], pa.bool_())
            grams = pa.array([grams.tobytes() for grams in made], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["rep"], batch["set_key"], grams], names=["rep", "set_key", "grams"]).filter(same)

    whole = texts.mapInArrow(whole_sets, "rep long, set_key binary, grams binary").dropDuplicates(["set_key"])

    def link(group: pa.Table) -> pa.Table:
        order = np.argsort(group["rep"].to_numpy(), kind="stable")  # roots are then the smallest ids
        held, reps = group["grams"].combine_chunks(), group["rep"].to_numpy()[order]
        sets = [np.frombuffer(held[i].as_buffer(), np.uint64) for i in order.tolist()]
        found = np.array(forest(overlaps(sets, percent), reps) if len(sets) > 1 else [], np.int64).reshape(-1, 2)
        return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    links = placed.join(whole.drop("rep"), "set_key").groupBy(*tile, "part").applyInArrow(link, "a long, b long")
    linked = components(links)
    named = classes.select("set_key", "rep").join(linked, F.col("rep") == F.col("id"), "left")
    named = named.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    result = sets.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one that names it.

    Rows without an id stay, since nothing can name them; they take no part in the join.
    Columns may have any names.
    """
    found = ngram_components(docs, n, percent, id_col, text_col)
    [name] = unused(docs, "gone")
    key = F.col(quoted(id_col)).cast("long")
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias(name)).distinct()
    kept = docs.where(key.isNotNull()).join(gone, key == F.col(name), "left_anti")
    return kept.unionByName(docs.where(key.isNull()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by word trigrams, linked from 90 % on."""
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90)

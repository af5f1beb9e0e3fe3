"""Incremental, reversible line dedup: exact reference counts behind sharded cuckoo filters.

The state of a corpus is three tables:

* ``refs``: (key, doc_id), each document's distinct line keys, the exact record;
* ``counts``: (key, n_docs, keep_doc), the exact reference counts derived from it;
* ``filters``: (shard, slots), a cuckoo filter per shard over the keys that are held by
  enough documents to be dropped. Shards go by the hash of the key; there are as many as
  the number of such keys asks for, and when they have filled, twice as many take over.

Inserting documents adds references, deleting them takes references away. In both cases
only keys of those documents are counted anew, as a layer over the counts before: keys that
reach the limit are put into their shard's filter, keys that fall below it are deleted from
it, and filters without such a key are left alone. Layers are merged once there are many.
Lines are looked up in the filter first; the few that pass are confirmed against the exact
counts, so a false positive never drops a line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tributary.llm.names import quoted, unused
from tributary.operators.aggregates import collapse
from tributary.sources.scratch import stored

MIN_CHARS = 20
MIN_DOCS = 3
#: Keys of a shard on average, at most, and buckets of its filter, which are then half full.
SHARD_KEYS = 1 << 15
BUCKETS = 1 << 14
#: Insertions and deletions after which the layers of a state are merged.
LAYERS = 8
#: References of one shard that are probed together in one task.
PROBE_ROWS = 200_000
SPACE = b" \t\n\r\x0b\x0c"

REFS = "key binary, doc_id long"
COUNTS = "key binary, n_docs long, keep_doc long"
FILTERS = "shard int, slots binary"


class CuckooFilter:
    """A cuckoo filter with four 16-bit fingerprints per bucket; 0 is an empty slot."""

    KICKS = 500

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def of(cls, keys: list[bytes], buckets: int = 4) -> CuckooFilter:
        """A filter that holds ``keys``, of the given number of buckets or grown until all fit."""
        buckets = max(buckets, 1 << max(0, int(np.ceil(np.log2(max(1, len(keys)) / 3.4)))))
        while True:
            made = cls(np.zeros((buckets, 4), np.uint16))
            if all(made.insert(key) for key in keys):
                return made
            buckets *= 2

    @classmethod
    def of_bytes(cls, slots: bytes) -> CuckooFilter:
        return cls(np.frombuffer(slots, np.uint16).reshape(-1, 4).copy())

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of keys given as 64-bit halves."""
        mark = ((keys >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        mask = np.uint64(len(self.slots) - 1)
        first = keys & mask
        return mark, first, first ^ self._other(mark)

    def _other(self, mark):
        return (mark.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(len(self.slots) - 1)

    def contains(self, keys: list[bytes]) -> np.ndarray:
        """Whether each key may be held; a held key always is."""
        mark, first, second = self._places(_halves(keys))
        return (self.slots[first] == mark[:, None]).any(1) | (self.slots[second] == mark[:, None]).any(1)

    def insert(self, key: bytes) -> bool:
        """Add a key; False, with a key lost, if the filter is full."""
        mark, first, second = (x[0] for x in self._places(_halves([key])))
        for place in (first, second):
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = mark
                return True
        place = second
        for kick in range(self.KICKS):
            slot = kick % 4
            mark, self.slots[place, slot] = self.slots[place, slot], mark
            place = place ^ self._other(mark)
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = mark
                return True
        return False

    def delete(self, key: bytes) -> None:
        """Remove one copy of a held key."""
        mark, first, second = (x[0] for x in self._places(_halves([key])))
        for place in (first, second):
            held = np.flatnonzero(self.slots[place] == mark)
            if len(held):
                self.slots[place, held[0]] = 0
                return


def _halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8")[::2].copy() if len(keys) else np.empty(0, np.uint64)


@dataclass(frozen=True)
class State:
    """The tables of a corpus, and the limits its filters are built for.

    ``held`` is the number of keys in the filters, ``layers`` that of changes since the
    tables were last merged; a state nothing was inserted into yet has none and no shards.
    """

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS
    shards: int = 0
    held: int = 0
    layers: int = 0


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 128-bit key of a line, stripped and with A-Z lower-cased; None if it is short."""
    line = line.strip(SPACE)
    if len(line) < min_chars or len(line) < 4 * min_chars and len(line.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line.lower())


def line_refs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """The distinct (key, doc_id) of documents; rows without an id hold nothing.

    Rows of one id are one document.
    """

    def refs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = [], []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py().encode()
                if len(text) >= min_chars:
                    own = {line_key(line, min_chars) for line in text.split(b"\n")}
                    own.discard(None)
                    keys += own
                    ids += [doc] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"))
    return rows.where("doc_id is not null").mapInArrow(refs, REFS).distinct()


def _counts(refs: DataFrame) -> DataFrame:
    """Exact counts, combined map-side: a line in a third of all documents is no hot group."""
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep_doc"))


def empty_state(spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> State:
    tables = [spark.createDataFrame([], schema) for schema in (REFS, COUNTS, FILTERS)]
    return State(*tables, min_docs, min_chars)


def insert(state: State, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> State:
    """The state with the lines of ``docs`` added; references it already has stay single.

    What is stored are the new references and the new counts of their keys.
    """
    added = line_refs(docs, id_col, text_col, state.min_chars)
    if state.shards:
        # References that documents of these ids had before; a new id has none.
        added = stored(added, "refs")
        known = state.refs.join(added.select("doc_id").distinct(), "doc_id", "left_semi")
        added = added.join(known, ["key", "doc_id"], "left_anti")
    added = stored(added, "refs")
    delta = _counts(added)
    if state.shards:
        keys = delta.select("key")
        before = state.counts.join(keys, "key", "left_semi").withColumn("was", F.col("n_docs"))
        both = before.unionByName(delta.withColumn("was", F.lit(0).cast("long")))
        sums = [F.sum("n_docs").alias("n_docs"), F.max("keep_doc").alias("keep_doc"), F.max("was").alias("was")]
        touched = both.groupBy("key").agg(*sums)
    else:
        touched = delta.withColumn("was", F.lit(0).cast("long"))
    refs = state.refs.unionByName(added) if state.shards else added
    return _next(state, refs, stored(touched, "counts"))


def delete(state: State, ids: DataFrame, id_col: str = "doc_id") -> State:
    """The state without the documents whose ids are given, as if they had never come.

    What is stored are their references and the new counts of their keys. The references
    of other documents are only looked at for keys whose last document has gone.
    """
    gone = ids.select(F.col(quoted(id_col)).cast("long").alias("doc_id")).distinct()
    lost = stored(state.refs.join(gone, "doc_id", "left_semi").select("key", "doc_id"), "refs")
    refs = state.refs.join(gone, "doc_id", "left_anti").select("key", "doc_id")
    per_key = lost.groupBy("key").agg(F.count(F.lit(1)).alias("lost"), F.max("doc_id").alias("last"))
    fewer = state.counts.join(per_key, "key").withColumn("was", F.col("n_docs")).withColumn("n_docs", F.col("n_docs") - F.col("lost"))
    fewer = stored(fewer, "counts")
    orphans = fewer.where("n_docs > 0 and keep_doc = last").select("key")
    heirs = stored(refs.join(orphans, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("heir")), "heirs")
    touched = fewer.join(heirs, "key", "left").select("key", "n_docs", F.coalesce("heir", "keep_doc").alias("keep_doc"), "was")
    return _next(state, refs, stored(touched, "counts"))


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def _next(state: State, refs: DataFrame, touched: DataFrame) -> State:
    """The state with new counts (key, n_docs, keep_doc, was) for some keys, and its filters."""
    now, was = (F.col(name) >= state.min_docs for name in ("n_docs", "was"))
    current = touched.where("n_docs > 0").select("key", "n_docs", "keep_doc")
    counts = state.counts.join(touched.select("key"), "key", "left_anti").unionByName(current) if state.shards else current
    change = touched.agg(F.count(F.when(now, 1)) - F.count(F.when(was, 1))).first()[0]
    held = state.held + change
    shards = max(state.shards, 1)
    while held > shards * SHARD_KEYS:
        shards *= 2
    filters = None
    if shards == state.shards:
        filters = _changed_filters(state, touched.where(now != was).select("key", now.alias("now")))
        shards *= 1 if filters is not None else 2
    if filters is None:  # the shards are new
        filters = _new_filters(counts.where(now), shards)
    layers = state.layers + 1
    if layers > LAYERS:
        refs, counts, filters, layers = stored(refs, "refs"), stored(counts, "counts"), stored(filters, "filters"), 1
    return State(refs, counts, filters, state.min_docs, state.min_chars, shards, held, layers)


def _new_filters(keys: DataFrame, shards: int) -> DataFrame:
    """Filters made from all keys."""

    def make(key, group: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(list(group["key"]), BUCKETS)
        return pd.DataFrame({"shard": [key[0]], "slots": [made.slots.tobytes()]})

    return stored(keys.select(shard_of(shards), "key").groupBy("shard").applyInPandas(make, FILTERS), "filters")


def _changed_filters(state: State, crossed: DataFrame) -> DataFrame | None:
    """The filters after keys (key, now) have crossed the limit; None if one is full."""

    def change(key, keys: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        if not len(keys):
            return pd.DataFrame({"shard": [], "slots": []})
        made = CuckooFilter.of_bytes(old["slots"].iloc[0]) if len(old) else CuckooFilter.of([], BUCKETS)
        for held in keys["key"][~keys["now"]]:
            made.delete(held)
        full = not all(made.insert(held) for held in keys["key"][keys["now"]])
        return pd.DataFrame({"shard": [key[0]], "slots": [None if full else made.slots.tobytes()]})

    groups = crossed.select(shard_of(state.shards), "key", "now").groupBy("shard").cogroup(state.filters.groupBy("shard"))
    changed = stored(groups.applyInPandas(change, FILTERS), "filters")
    if not changed.where("slots is null").isEmpty():
        return None
    return state.filters.join(changed.select("shard"), "shard", "left_anti").unionByName(changed)


def repeated_lines(state: State) -> DataFrame:
    """(doc_id, key) of every line that its document loses.

    References are probed against their shard's filter in groups of about PROBE_ROWS: a
    shard is cut by document into as many parts as its own size asks for, each with a
    copy of the filter, so a line held by a third of all documents is spread as well. What
    passes is confirmed against the exact counts.
    """
    refs = state.refs.select(shard_of(max(state.shards, 1)), "key", "doc_id")
    # Stored, so that its size is known when the join is planned: a row per shard is small
    # enough to be sent around, and the references need not move to meet it.
    sizes = stored(refs.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PROBE_ROWS).cast("int").alias("parts")), "sizes")
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part")
    probes = refs.join(sizes, "shard").select("shard", part, "key", "doc_id")
    copies = state.filters.join(sizes, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "slots"
    )

    def probe(key, refs: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if not len(refs) or not len(filters):
            return refs.iloc[:0][["key", "doc_id"]]
        made = CuckooFilter.of_bytes(filters["slots"].iloc[0])
        return refs[made.contains(list(refs["key"]))][["key", "doc_id"]]

    groups = probes.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part"))
    passed = groups.applyInPandas(probe, REFS)
    exact = state.counts.where(F.col("n_docs") >= state.min_docs).select("key", "keep_doc")
    return passed.join(exact, "key").where("doc_id != keep_doc").select("doc_id", "key")


def drop_repeated_lines(docs: DataFrame, state: State, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that ``state`` drops, with ``n_lines`` and ``n_dropped``.

    A null text is one empty line and becomes empty. A line that a document holds several
    times is dropped or kept in all its places. Documents unknown to the state and rows
    without an id lose nothing; every row stays. Columns named ``n_lines`` and ``n_dropped``
    are replaced, all others pass, whatever their names. Rows without an id take no part in
    the join, and those of a frequent id can be split among tasks there.
    """
    min_chars = state.min_chars
    rows = docs.drop("n_lines", "n_dropped")
    columns, place = rows.columns, rows.columns.index(text_col)
    id_name, drop_name = unused(rows, "id", "drop")
    lists = collapse(repeated_lines(state), "doc_id", drop=F.array_join(F.collect_list(F.hex("key")), ""))
    lists = lists.toDF(id_name, drop_name)
    key = F.col(quoted(id_col)).cast("long")
    rows = rows.withColumn(text_col, F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")))
    joined = rows.where(key.isNotNull()).join(lists, key == F.col(id_name), "left").drop(id_name)
    joined = joined.unionByName(rows.where(key.isNull()).withColumn(drop_name, F.lit(None).cast("string")))
    schema = StructType([*rows.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, drop in zip(batch.column(place), batch.column(len(columns))):
                text, drop = text.as_py(), drop.as_py()
                kept = own = text.split("\n")
                if drop:
                    raw = bytes.fromhex(drop)
                    held = {raw[i : i + 16] for i in range(0, len(raw), 16)}
                    kept = [line for line in own if line_key(line.encode(), min_chars) not in held]
                    text = "\n".join(kept)
                texts.append(text)
                lines.append(len(own))
                dropped.append(len(own) - len(kept))
            arrays = [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*columns, "n_lines", "n_dropped"])

    # Columns go in by place, so that any name will do.
    return joined.toDF(*[f"c{i}" for i in range(len(columns) + 1)]).mapInArrow(rewrite, schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """A whole corpus deduplicated against itself: inserted into an empty state, rewritten."""
    state = insert(empty_state(docs.sparkSession, min_docs, min_chars), docs, id_col, text_col)
    return drop_repeated_lines(docs, state, id_col, text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated lines, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT rid, doc_id, i, lines[i] AS line,
         translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), held AS (
  SELECT key, max(doc_id) AS keep_doc FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT rid, doc_id, i, line, coalesce(doc_id <> keep_doc, false) AS dropped FROM lines LEFT JOIN held USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY rid
"""

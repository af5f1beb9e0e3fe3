"""Language identification by cross-parsing entropy.

Labelled text of each language becomes a suffix automaton. A text is then parsed greedily
against it: a phrase is the longest match from where the last one ended. A phrase costs the
logarithm of the reference's length, a pointer into it, so the language whose phrases cost
the fewest bits per byte describes the text best and wins.

The automata are built from the sampled references by each Python worker, once, and hold
their transitions as one table; thousands of pieces of text step through it side by side.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tributary.llm.words import text_slices

#: Bound of the training sample: so many pieces of so many characters for each language.
MAX_PIECES = 128
PIECE_CHARS = 512
#: Parsing starts anew after so many bytes, so that a long text is parsed side by side.
SPAN = 1024
#: Pieces of text that step through the automata together.
LANES = 4096
#: Bytes of text that count as evidence in the score; more make it no surer.
EVIDENCE = 64
UNDETERMINED = "und"

#: Between pieces of a reference; no text holds it.
SEPARATOR = 0
SPACE = 0x20
#: Bytes as they are compared: letters and bytes beyond ASCII stay, the rest is a space.
NORMAL = np.full(256, SPACE, np.uint8)
NORMAL[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
NORMAL[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
NORMAL[128:] = np.arange(128, 256)


def normalized(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of the texts with each run of other characters as one space."""
    flat = NORMAL[data]
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != SPACE) | (flat[:-1] != SPACE)
    starts = offsets[:-1]
    keep[starts[starts < len(flat)]] = True
    places = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(keep, out=places[1:])
    return places[offsets], flat[keep]


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", max_pieces: int = MAX_PIECES) -> dict[str, bytes]:
    """A reference text for each language, from at most ``max_pieces`` pieces of its text.

    Texts are cut into pieces. The distinct pieces of a language are counted by hash, and
    those with the smallest hashes are taken, so copies of a text count once and the same
    rows give the same references however they are stored. What reaches the driver is
    bounded by the number of languages alone: 64 KB for each of them by default. Rows
    whose language or text is null are not used. An empty table teaches no language.
    """
    named = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    named = named.where("lang IS NOT NULL AND text IS NOT NULL")
    marks = named.mapInArrow(_pieces(None), "lang string, mark long").distinct()
    limits = {}
    for row in marks.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        share = 0.9 * max_pieces / row["n"] if row["n"] > max_pieces else 1.0
        limits[row["lang"]] = -(1 << 63) + int(share * ((1 << 64) - 1))
    taken = named.mapInArrow(_pieces(limits), "lang string, mark long, piece string").distinct()
    found = defaultdict(list)
    for row in sorted(taken.collect()):
        found[row["lang"]].append(row["piece"])
    return {lang: _reference(pieces[:max_pieces]) for lang, pieces in sorted(found.items())}


def _pieces(limits: dict[str, int] | None):
    """(lang, hash) of each piece, or with limits those up to a language's limit and their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                # A text at a time, so that a long one is in memory only once.
                pieces = [text[at : at + PIECE_CHARS] for at in range(0, len(text), PIECE_CHARS)]
                marks = [xxhash.xxh64_intdigest(piece.encode()) - (1 << 63) for piece in pieces]
                if limits is not None:
                    chosen = [i for i, mark in enumerate(marks) if mark <= limits.get(lang, -(1 << 63) - 1)]
                    pieces, marks = [pieces[i] for i in chosen], [marks[i] for i in chosen]
                if not marks:
                    continue
                columns = {"lang": pa.array([lang] * len(marks)), "mark": pa.array(marks, pa.int64())}
                if limits is not None:
                    columns["piece"] = pa.array(pieces, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _reference(pieces: list[str]) -> bytes:
    texts = pa.array(pieces, pa.string())
    parts = []
    for _, _, offsets, data in text_slices(pc.utf8_lower(texts)):
        offsets, flat = normalized(offsets, data)
        parts += [flat[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(offsets) - 1)]
    return bytes([SEPARATOR]).join(parts)


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the empty one."""
    steps: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in text:
        state = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in steps[at]:
            steps[at][symbol] = state
            at = link[at]
        if at != -1:
            target = steps[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(steps)
                steps.append(dict(steps[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at != -1 and steps[at].get(symbol) == target:
                    steps[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return steps


@dataclass
class Parser:
    """Greedy parsing against one reference.

    ``table[state * width + symbol]`` is four times the next state's row, plus the number of
    phrases that end by the step: none inside a match, one where it ends, one more for a
    symbol that the reference lacks.
    """

    table: np.ndarray
    symbols: np.ndarray
    bits: float

    @classmethod
    def build(cls, reference: bytes) -> Parser:
        steps = suffix_automaton(reference)
        seen = sorted(set(reference) - {SEPARATOR})
        symbols = np.zeros(256, np.int32)  # symbol 0: not in the reference
        symbols[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        # What a mismatch does is the same in all states: the phrase ends, a new one begins.
        restart = np.ones(width, np.int64)
        for symbol, state in steps[0].items():
            if symbol != SEPARATOR:
                restart[symbols[symbol]] = 4 * width * state
        table = np.tile(restart + 1, (len(steps), 1))
        table[0] = restart
        rows = np.repeat(np.arange(len(steps)), [len(row) for row in steps])
        keys = np.fromiter((symbol for row in steps for symbol in row), np.int64, len(rows))
        to = np.fromiter((state for row in steps for state in row.values()), np.int64, len(rows))
        inside = keys != SEPARATOR
        table[rows[inside], symbols[keys[inside]]] = 4 * width * to[inside]
        return cls(table.ravel().astype(np.int32), symbols, math.log2(len(reference) + 1))

    def phrases(self, columns: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each lane; ``columns[i]`` are the i-th bytes of the ``active[i]`` longest lanes."""
        state = np.zeros(columns.shape[1], np.int32)
        count = np.zeros(columns.shape[1], np.int32)
        for i, lanes in enumerate(active):
            step = self.table[state[:lanes] + self.symbols[columns[i, :lanes]]]
            count[:lanes] += step & 3
            state[:lanes] = step >> 2
        return count + (state > 0)


def _lanes(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length) of the spans of all texts, longest first."""
    sizes = np.diff(offsets)
    spans = -(-sizes // SPAN)
    text = np.repeat(np.arange(len(sizes)), spans)
    within = np.arange(len(text)) - np.repeat(np.cumsum(spans) - spans, spans)
    start = offsets[text] + within * SPAN
    length = np.minimum(offsets[text + 1] - start, SPAN)
    order = np.argsort(-length, kind="stable")
    return text[order], start[order], length[order]


def code_lengths(parsers: list[Parser], offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Bits of each text (row) under each language (column)."""
    text, start, length = _lanes(offsets)
    counts = np.zeros((len(offsets) - 1, len(parsers)))
    for first in range(0, len(text), LANES):
        own = slice(first, first + LANES)
        longest = int(length[own][0])
        places = start[own] + np.arange(longest)[:, None]
        columns = data[np.minimum(places, len(data) - 1)]
        active = np.searchsorted(-length[own], -np.arange(longest), "left")
        for number, parser in enumerate(parsers):
            np.add.at(counts[:, number], text[own], parser.phrases(columns, active))
    return counts * [parser.bits for parser in parsers]


_built: dict[str, list[Parser]] = {}


def _parsers(references: dict[str, bytes]) -> list[Parser]:
    """The parsers of a model, built once by each Python worker: about 20 MB for each language."""
    key = xxhash.xxh128_hexdigest(repr(sorted(references.items())))
    if key not in _built:
        _built.clear()
        _built[key] = [Parser.build(references[lang]) for lang in sorted(references)]
    return _built[key]


def predict(docs: DataFrame, references: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` after ``lang_pred`` and ``score``; columns of these names give way.

    Every row gives a row, and whole texts count, however long. A null text, one without a
    letter, and any text when no language was learned is ``und`` with score 0. The score is
    the winner's share when each language weighs 2 to the power of minus its bits for the
    first ``EVIDENCE`` bytes at the text's average. Equal languages: the first by name.
    """
    langs = sorted(references)
    kept = [field for field in docs.schema if field.name.lower() not in ("lang_pred", "score")]
    others = [field.name for field in kept]
    # Columns go in by place, so that no name can clash.
    frame = docs.select(F.col(text_col).cast("string"), *[F.col("`" + name.replace("`", "``") + "`") for name in others])
    frame = frame.toDF("text", *[f"c{place}" for place in range(len(others))])
    out = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()), *kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsers = _parsers(references)
        for batch in batches:
            texts = batch.column(0)
            bits, sizes = [np.zeros((0, len(langs)))], [np.zeros(0, np.int64)]
            for _, _, offsets, data in text_slices(pc.utf8_lower(texts)):
                offsets, flat = normalized(offsets, data)
                bits.append(code_lengths(parsers, offsets, flat))
                sizes.append(np.diff(offsets))
            found, score = _decide(np.concatenate(bits), np.concatenate(sizes))
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            known = letters & (len(langs) > 0)
            names = [langs[place] if ok else UNDETERMINED for place, ok in zip(found, known)]
            arrays = [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang_pred", "score", *others])

    return frame.mapInArrow(run, out)


def _decide(bits: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not bits.shape[1]:
        return np.zeros(len(bits), np.int64), np.zeros(len(bits))
    rate = bits / np.maximum(sizes, 1)[:, None]
    found = rate.argmin(1)
    behind = (rate - rate.min(1, keepdims=True)) * np.minimum(sizes, EVIDENCE)[:, None]
    return found, 1 / np.exp2(-behind).sum(1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; documents whose crc32(doc_id) leaves 1 modulo 3 are held out of the learning.

    A row whose doc_id is null is not held out.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    held_out = F.coalesce(fold, F.lit(False)).alias("held_out")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    references = learn(docs.where(~held_out))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, "text")
    return predict(narrow, references).select("doc_id", "held_out", "lang_pred", "score")

"""Records out of JSON files of any size, one at a time.

A file holds one JSON value over any number of lines: a list of records, an object that
wraps the list, or a single record. Spark's text reader brings the file, cut wherever an
object may begin, so what it holds at once is never more than one record; the pieces are
put together again as they come, and each record leaves as soon as it is complete.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: field that wraps the list of records in an envelope.
ENVELOPE = "results"
#: Characters a record may have; a VARIANT value holds no more bytes.
MAX_RECORD = 128 << 20
#: Characters of a file that travel together.
PIECE = 1 << 20
#: Endings of compressed files, which one task reads from start to end.
COMPRESSED = (".gz", ".deflate", ".zst", ".lz4", ".snappy")

#: What every record begins with. A JSON value cannot end with it, so none is lost at the end.
CUT = "{"
SPACE = re.compile(r"[ \t\n\r]*")
PIECES = "file string, start long, number long, piece string"
RECORDS = "json string"


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """(json): the text of every record in the files under ``path``.

    A compressed file is one task's work from its first byte to its last. Other files are
    read in parts, and the pieces of each meet, in order, in one task, since where a record
    begins is only known from the start of the file. Either way a task holds a few pieces
    and one record. A file that ends too early or holds anything else fails the read; an
    empty one has no records.
    """
    pieces = (
        spark.read.option("lineSep", CUT).text(path)
        .select("value", "_metadata.file_path", "_metadata.file_name", "_metadata.file_block_start")
    )
    # The name is known before a file is opened, so either side opens its own files only.
    compressed = F.lit(False)
    for ending in COMPRESSED:
        compressed = compressed | F.col("file_name").endswith(ending)
    as_read = pieces.where(compressed).drop("file_name").mapInArrow(_joined, PIECES)
    in_parts = pieces.where(~compressed).drop("file_name").mapInArrow(_joined, PIECES)
    in_order = in_parts.repartition("file").sortWithinPartitions("file", "start", "number")
    return as_read.mapInArrow(_records, RECORDS).unionByName(in_order.mapInArrow(_records, RECORDS))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of about PIECE characters from the fragments between the cuts."""
    number = 0
    for batch in batches:
        fragments, files, starts = (column.to_pylist() for column in batch.columns)
        first = 0
        rows = []
        while first < len(fragments):
            after, size = first, 0
            while after < len(fragments) and size < PIECE and (files[after], starts[after]) == (files[first], starts[first]):
                size += len(fragments[after]) + 1
                after += 1
            rows.append((files[first], starts[first], number, CUT.join(fragments[first:after])))
            number, first = number + 1, after
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names=["file", "start", "number", "piece"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple[str, str]]:
        for batch in batches:
            for file, piece in zip(batch["file"], batch["piece"]):
                yield file.as_py(), piece.as_py()

    found, size = [], 0
    for file, own in groupby(pieces(), itemgetter(0)):
        try:
            for record in records(piece for _, piece in own):
                found.append(record)
                size += len(record)
                if size >= PIECE:
                    yield pa.RecordBatch.from_pydict({"json": pa.array(found, pa.string())})
                    found, size = [], 0
        except ValueError as problem:
            raise ValueError(f"{problem}, in {file}") from problem
    yield pa.RecordBatch.from_pydict({"json": pa.array(found, pa.string())})


def records(pieces: Iterator[str]) -> Iterator[str]:
    """The JSON text of each record of one file, whose pieces lack the CUT between them."""
    pieces = iter(pieces)
    first = next(pieces, None)
    if first is None:
        return
    text = _Text(first, pieces)
    begin = text.peek()
    if begin == "[":
        yield from _elements(text)
    elif begin == "{":
        yield from _object(text)
    elif begin:
        raise ValueError("a record is not an object")
    else:
        raise ValueError("malformed JSON: the file has no value")
    if text.peek():
        raise ValueError("malformed JSON: text after the value")


def _elements(text: _Text) -> Iterator[str]:
    """The elements of a list, which have to be objects."""
    text.take("[")
    if text.peek() == "]":
        text.take("]")
        return
    while True:
        if text.peek() not in ("{", ""):
            raise ValueError("a record is not an object")
        yield text.value()
        if text.take(",", "]") == "]":
            return


def _object(text: _Text) -> Iterator[str]:
    """The records of an envelope, else the object as a record."""
    text.take("{")
    members = []
    wrapped = False
    closed = text.peek() == "}" and text.take("}")
    while not closed:
        if text.peek() not in ('"', ""):
            raise ValueError("malformed JSON: a field without a name")
        key = text.value()
        text.take(":")
        if json.loads(key) == ENVELOPE:
            if wrapped or text.peek() not in ("[", ""):
                raise ValueError(f"{ENVELOPE} is not a list")
            yield from _elements(text)
            wrapped = True
        else:
            value = text.value()
            if not wrapped:
                members.append(f"{key}:{value}")
        closed = text.take(",", "}") == "}"
    if not wrapped:
        yield "{" + ",".join(members) + "}"


class _Text:
    """A cursor over text that arrives in pieces; what lies behind it is forgotten."""

    decoder = json.JSONDecoder()

    def __init__(self, first: str, others: Iterator[str]):
        self.pieces = others
        self.held = first.removeprefix("\ufeff")
        self.at = 0

    def more(self) -> bool:
        """At least as much again as is left; False at the end of the file."""
        parts = [self.held[self.at :]]
        size = 0
        while size <= len(parts[0]):
            piece = next(self.pieces, None)
            if piece is None:
                break
            parts.append(piece)
            size += len(piece) + 1
        self.held, self.at = CUT.join(parts), 0
        return len(parts) > 1

    def peek(self) -> str:
        """The next character that is no space; empty at the end."""
        while True:
            self.at = SPACE.match(self.held, self.at).end()
            if self.at < len(self.held):
                return self.held[self.at]
            if not self.more():
                return ""

    def take(self, *expected: str) -> str:
        found = self.peek()
        if found not in expected or not found:
            wanted = " or ".join(expected)
            raise ValueError(f"malformed JSON: {wanted} expected, {found or 'the end of the file'} found")
        self.at += 1
        return found

    def value(self) -> str:
        """The text of the next value, read until it is complete."""
        self.peek()
        while True:
            try:
                _, end = self.decoder.raw_decode(self.held, self.at)
            except ValueError as problem:
                if len(self.held) - self.at > MAX_RECORD:
                    raise ValueError(f"a JSON value is malformed, or too large for VARIANT_SIZE_LIMIT: {problem}") from None
                if not self.more():
                    raise ValueError(f"malformed JSON: the file ends inside a value: {problem}") from None
                continue
            found = self.held[self.at : end]
            self.at = end
            return found

"""Packing by lexical retrieval: each window is filled with what BM25 finds near its seed.

Documents are tokenized once. A text's full windows are sequences by themselves; the rests
are dealt to shards of a bounded number of tokens, similar ones near each other. Each shard
builds a BM25 inverted index of its texts. The next unused text is the seed of a window; its
unused neighbours, best first, fill the window, and the last one is cut where the window
ends. What is left of it is unused again. What a shard has left, less than a window, goes on
to a further round of shards, until one shard is left.

The shards follow from the tokens alone, so the windows do not depend on the session.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.llm.names import quoted
from tributary.sources.scratch import stored

WINDOW = 4096
#: Tokens of a shard: about so many are held, indexed and packed together.
SHARD_TOKENS = 1_000_000
#: Ranges of places whose tokens are counted to draw the limits of shards: 2**RANGE_BITS.
RANGE_BITS = 16
#: The id that ends each document.
END = 2
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a Python worker remembers, the first it meets.
REMEMBERED = 400_000
K1, B = 1.2, 0.75
#: A piece of a document, and what is left of one for the next round.
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
TAIL = "row long, place long, first long, n long, ids binary"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Token ids of texts, word by word, as the tokenizers library gives them.

    This vocabulary's pieces never reach across white space, so a text's ids are those of
    its words, one after the other, and a word that came before needs no encoding.

    Words of plain Latin letters, digits and marks are merged by rank, with the end of a
    word as a byte of its own that no UTF-8 text holds. All others go to the library.
    """

    #: Visible ASCII and Latin letters that Unicode normal form leaves as they are.
    PLAIN = re.compile("[!-~\u00a1-\u012f\u0131-\u0148\u014a-\u017f]*")
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    WORD_END = b"\xff"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # The first 512 ids are the bytes, alone and at a word's end, and give the alphabet.
        names = sorted(self.library.get_vocab(with_added_tokens=False).items(), key=lambda pair: pair[1])
        names = [name for name, _ in names if not name.startswith("<|")]
        order = [*range(33, 127), *range(161, 173), *range(174, 256)]
        order += [byte for byte in range(256) if byte not in order]
        alphabet = {name: byte for name, byte in zip(names, order)}
        ranks = {}
        for rank, name in enumerate(names):
            body = name.removesuffix("</w>")
            ranks[bytes(alphabet[c] for c in body) + self.WORD_END * (body != name)] = rank
        self.merged = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.known: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        """Ids of a text in UTF-8, as little-endian unsigned 16-bit numbers."""
        words = text.split()
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            return b"".join([self.known[word] if word in self.known else self._word(word) for word in words])

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.PLAIN.fullmatch(text) and "<|" not in text:
            ids = []
            for piece in self.PIECES.findall(text.lower()):
                ids += self.merged.encode_single_piece(piece.encode() + self.WORD_END)
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        encoded = np.array(ids, "<u2").tobytes()
        if len(self.known) < REMEMBERED:
            self.known[word] = encoded
        return encoded


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker."""
    return WordTokenizer(path)


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW) -> DataFrame:
    """The full windows of each row's tokens as pieces, and the rest of its tokens.

    A row's tokens are those of its text and END; null counts as empty and has END alone.
    A full window is a sequence of its own and needs no more than its checksum. The rest is
    a row with ``ids``: its ``row`` number, different for every row, that of copies too; a
    ``place`` for sharding; the tokens before it and all tokens of the text. ``place`` is
    the smallest hash of the text's words, which texts share in proportion to the words
    they share.
    """
    path = path or vocabulary_path()
    names = ["doc_id", *_names(PIECES), *_names(TAIL)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], "<u2").tobytes()
        row = TaskContext.get().partitionId() << 33
        number = (1 << 62) + (TaskContext.get().partitionId() << 36)
        for batch in batches:
            own = tokenizer(path)
            owners, rows = [], []
            for i, text in enumerate(batch["text"]):
                ids = np.frombuffer(own.encode((text.as_py() or "").encode()) + end, "<u2")
                first = len(ids) // window * window
                for start in range(0, first, window):
                    rows.append((start, window, _crc(ids[start : start + window]), len(ids), number, 0, *[None] * 5))
                    number += 1
                if len(ids) > first:
                    rows.append((*[None] * 6, row + i, _place(ids), first, len(ids), ids[first:].tobytes()))
                owners += [i] * (len(rows) - len(owners))
            row += batch.num_rows
            if rows:
                kinds = [*[pa.int64()] * 10, pa.binary()]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(owners)), *columns], names=names)

    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PIECES}, {TAIL}")


_random = np.random.default_rng(11)
_PAIR = _random.integers(1, 1 << 62, 2, dtype=np.int64) * 2 + 1


def _place(ids: np.ndarray) -> int:
    """The smallest hash among pairs of neighbouring tokens."""
    ids = ids.astype(np.int64)
    pairs = (ids[:-1] * _PAIR[0] + ids[1:] * _PAIR[1]) if len(ids) > 1 else ids * _PAIR[0]
    return int(((pairs ^ (pairs >> 29)) * _PAIR[1]).min())


class Shard:
    """A BM25 inverted index over the token ids of a shard's texts."""

    def __init__(self, texts: list[np.ndarray]):
        found = [np.unique(text, return_counts=True) for text in texts]
        self.terms = [terms for terms, _ in found]
        sizes = np.array([len(text) for text in texts], np.float64)
        owner = np.repeat(np.arange(len(texts)), [len(terms) for terms in self.terms])
        terms = np.concatenate(self.terms).astype(np.int64)
        counts = np.concatenate([c for _, c in found])
        order = np.argsort(terms, kind="stable")
        held = np.bincount(terms)
        idf = np.log1p((len(texts) - held + 0.5) / (held + 0.5))
        norm = K1 * (1 - B + B * sizes / sizes.mean())
        weight = idf[terms] * counts * (K1 + 1) / (counts + norm[owner])
        self.owner, self.weight = owner[order], weight[order]
        self.begin = np.concatenate(([0], np.cumsum(held)))
        self.size = self.held = len(texts)

    def keep(self, unused: np.ndarray) -> None:
        """Forget the postings of used texts, once they are a quarter of those it holds."""
        left = int(np.count_nonzero(unused))
        if left > 0.75 * self.held:
            return
        kept = unused[self.owner]
        before = np.concatenate(([0], np.cumsum(kept)))
        self.owner, self.weight, self.begin = self.owner[kept], self.weight[kept], before[self.begin]
        self.held = left

    def scores(self, text: int) -> np.ndarray:
        """The BM25 score of every text for the terms of one, in a term's posting order."""
        terms = self.terms[text].astype(np.int64)
        begin, length = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        postings = np.repeat(begin - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
        return np.bincount(self.owner[postings], self.weight[postings], self.size)


def pack_shard(texts: list[np.ndarray], window: int = WINDOW, last: bool = True) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Sequences of (text, start, length) that fill windows, and what is left over.

    A text's full windows, if it has any, come first, by themselves. Its rest is a seed or
    a neighbour.
    With ``last``, the final tokens, too few for a window, go into sequences of powers of
    two, which need no padding; else they are left over for the next round.
    """
    sequences = []
    rest = {}
    for number, text in enumerate(texts):
        full = len(text) // window * window
        sequences += [[(number, start, window)] for start in range(0, full, window)]
        if len(text) > full:
            rest[number] = full
    index = Shard(texts) if len(rest) > 1 else None
    total = sum(len(texts[n]) - start for n, start in rest.items())
    unused = np.zeros(len(texts), bool)
    unused[list(rest)] = True
    room = window

    def take(number: int) -> None:
        nonlocal room
        start = rest[number]
        length = min(room, len(texts[number]) - start)
        sequences[-1].append((number, start, length))
        room -= length
        rest[number] = start + length
        unused[number] = rest[number] < len(texts[number])

    seed = 0
    while total >= window:
        while not unused[seed]:
            seed += 1
        sequences.append([])
        room = window
        take(seed)
        if room:
            index.keep(unused)
            scores = np.where(unused, index.scores(seed), -1.0)
            for number in np.argsort(-scores, kind="stable"):
                if not room or scores[number] < 0:
                    break
                take(int(number))
        total -= window
    if not last:
        return sequences, [(n, start, len(texts[n])) for n, start in rest.items() if unused[n]]
    while total:
        sequences.append([])
        room = 1 << (total.bit_length() - 1)
        total -= room
        while room:
            take(int(np.flatnonzero(unused)[0]))
    return sequences, []


def pack(tokens: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of documents as ``tokenize`` gives them, in sequences of ``window`` tokens.

    Every token is in exactly one piece. Sequences hold ``window`` tokens, except the very
    last ones, which hold powers of two. A shard's texts are one group of bounded size, in
    the order of their places, so a lost task packs its shards again as they were. A round
    leaves less than a window of each shard's tokens to the next.
    """
    shard_tokens = max(shard_tokens, 4 * window)  # so that a round leaves half of it at most
    pieces, turn, final = [], 0, False
    while not final:
        pieces.append(tokens.where("ids IS NULL").select("doc_id", *_names(PIECES)))
        rests = tokens.where("ids IS NOT NULL").select("doc_id", *_names(TAIL))
        sharded, final = _sharded(rests, shard_tokens)
        packed = sharded.groupBy("shard").applyInArrow(_pack_rests(window, turn, final), tokens.schema)
        tokens = stored(packed, "packed")
        turn += 1
    pieces.append(tokens.select("doc_id", *_names(PIECES)))
    return reduce(DataFrame.unionByName, pieces)


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _sharded(rests: DataFrame, shard_tokens: int) -> tuple[DataFrame, bool]:
    """The texts with the number of their shard, and whether there is one shard only.

    The tokens in each of 2**RANGE_BITS ranges of places are counted; neighbouring ranges
    make a shard. A range with more tokens than a shard, as one that holds the copies of one
    text, is dealt to several by the hash of the row.
    """
    span = F.shiftrightunsigned("place", 64 - RANGE_BITS).cast("int")
    counts = rests.groupBy(span.alias("span")).agg(F.sum(F.col("n") - F.col("first")).alias("tokens"))
    limits, shard, size = [], -1, shard_tokens
    for row in counts.orderBy("span").collect():  # a row per range at most
        parts = -(-row["tokens"] // shard_tokens)
        if parts > 1 or size + row["tokens"] > shard_tokens:
            shard, size = shard + 1, 0
        limits.append((row["span"], shard, parts))
        size += row["tokens"]
        if parts > 1:
            shard, size = shard + parts - 1, shard_tokens
    table = rests.sparkSession.createDataFrame(limits, "span int, shard int, parts int")
    dealt = F.col("shard") + F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    # A row per range at most, whatever the corpus.
    sharded = rests.withColumn("span", span).join(F.broadcast(table), "span").withColumn("shard", dealt)
    return sharded.drop("span", "parts"), shard <= 0


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _pack_rests(window: int, turn: int, final: bool):
    """Pieces of the texts of a shard, and what the next round has to pack (ids is not null)."""
    names = ["doc_id", *_names(PIECES), *_names(TAIL)]

    def run(key: tuple, group: pa.Table) -> pa.Table:
        # Copies of one row differ in nothing but the row's number.
        group = group.sort_by([("place", "ascending"), ("row", "ascending")])
        texts = [np.frombuffer(ids, "<u2") for ids in group["ids"].to_pylist()]
        held = list(zip(*(group[name].to_pylist() for name in ("doc_id", "row", "place", "first", "n"))))
        number = (turn << 56) + (key[0].as_py() << 24)
        rows = []
        sequences, left = pack_shard(texts, window, final)
        for sequence in sequences:
            offset = 0
            for text, start, length in sequence:
                doc, _, _, first, n = held[text]
                crc = _crc(texts[text][start : start + length])
                rows.append((doc, first + start, length, crc, n, number, offset, *[None] * 5))
                offset += length
            number += 1
        for text, start, _ in left:
            doc, row, place, first, n = held[text]
            rows.append((doc, *[None] * 6, row, place, first + start, n, texts[text][start:].tobytes()))
        kinds = [group["doc_id"].type, *[pa.int64()] * 10, pa.binary()]
        return pa.table([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)

    return run


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Tokenize ``docs`` and pack them; one row per piece.

    Null text counts as empty; each row, repeated ids included, is a document of its own
    and has at least the END token. Columns other than the two named are not read. The
    tokens are stored once in the shared folder, as two bytes each.
    """
    return pack(stored(tokenize(docs, id_col, text_col, path, window), "tokens"), window, shard_tokens)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 4096 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

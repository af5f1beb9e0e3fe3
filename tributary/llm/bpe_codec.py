"""Byte-level BPE encoding by tree concatenation, and decoding.

Long texts are cut into leaves that are encoded in parallel. Neighbouring encodings are
then joined in a tree: around each join a window of tokens is decoded, encoded again as
one text, and widened until both sides agree with it; only then are the three spliced.

Why agreement suffices. The pattern that splits text into pieces scans from left to right
and looks one character ahead, so from a common piece boundary on, two scans of the same
text agree. Inside one long piece, a token sequence is the BPE encoding exactly if each
pair of neighbours is, and a token shared by both encodings makes every pair one that
occurs in either. Near the cut itself a special token or a contraction may be torn; sync
points therefore keep a distance of ``MARGIN`` bytes from every cut.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Code points per leaf. Texts up to this length are encoded as they are.
LEAF = 16_384
#: Tokens on each side of a join in the first window; each try doubles it.
WINDOW = 32
#: More than the bytes of any special token.
MARGIN = 32
VOCABULARY = "byte_bpe_50k"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The rank file of a public byte-level vocabulary, without its extension."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken").removesuffix(".tiktoken")


class Codec:
    """Encoder and decoder of one vocabulary; ``<|endoftext|>`` in a text is its own token."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        pairs = (line.split() for line in Path(f"{path}.tiktoken").read_bytes().splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        special = {"<|endoftext|>": len(ranks)}
        self.encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.bytes = [b""] * (len(ranks) + len(special))
        for token, rank in ranks.items():
            self.bytes[rank] = token
        for token, rank in special.items():
            self.bytes[rank] = token.encode()
        self.text_of = [str(i) for i in range(len(self.bytes))]

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all")

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def join(self, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
        """The encoding of the two texts together, from the encodings of each."""
        if not left or not right:
            return left or right
        while window < max(len(left), len(right)):
            spliced = self._splice(left, right, window)
            if spliced is not None:
                return spliced
            window *= 2
        return self.encode(self.decode(left + right))

    def _splice(self, left: list[int], right: list[int], window: int) -> list[int] | None:
        tail, head = left[-window:], right[:window]
        before, after = self.decode_bytes(tail), self.decode_bytes(head)
        # Left: the first token of the tail at which a scan may start.
        whole_left, whole_right = len(tail) == len(left), len(head) == len(right)
        skip = 0
        if not whole_left:
            skip = self._first_sync(tail, before, len(before) - MARGIN)
            if skip is None:
                return None
        start = sum(len(self.bytes[t]) for t in tail[:skip])
        # The window must not end inside a character, which has four bytes at most.
        while after and not whole_right and not _ends_whole(after):
            head = head[:-1]
            after = self.decode_bytes(head)
        try:
            text = (before[start:] + after).decode("utf-8")
        except UnicodeDecodeError:
            return None
        joined = self.encode(text)
        if not whole_left and joined[0] != tail[skip]:
            return None
        kept = left[: len(left) - len(tail) + skip]
        if whole_right:
            return kept + joined
        # Right: the first token both encodings have at the same place, well inside.
        place, cut, end = 0, len(before) - start, len(before) - start + len(after)
        at = {}
        for number, token in enumerate(joined):
            at[place] = (number, token)
            place += len(self.bytes[token])
        place = cut
        for number, token in enumerate(head):
            size = len(self.bytes[token])
            if place + size > end - MARGIN:
                return None
            if place >= cut + MARGIN and at.get(place, (0, -1))[1] == token:
                if self._is_sync(after, place - cut, size):
                    return kept + joined[: at[place][0]] + right[number:]
            place += size
        return None

    def _first_sync(self, tokens: list[int], text: bytes, limit: int) -> int | None:
        place = len(self.bytes[tokens[0]])
        for number, token in enumerate(tokens[1:], 1):
            size = len(self.bytes[token])
            if place + size > limit:
                return None
            if self._is_sync(text, place, size):
                return number
            place += size
        return None

    def _is_sync(self, text: bytes, place: int, size: int) -> bool:
        """Whether a scan that starts at this token splits what follows as any scan does.

        So it is at a space before a visible character and where letters, digits and other
        signs meet, for a piece always begins there, and within a run of one of these
        kinds. An apostrophe is left alone, since it may begin a contraction.
        """
        token = text[place : place + size]
        if token[0] == 0x20:
            return size > 1 and not token[1:].decode("utf-8", "replace")[0].isspace()
        if token[0] & 0xC0 == 0x80 or token[0] == 0x27 or token[-1:] == b"'":
            return False
        ahead = text[place : place + 4].decode("utf-8", "ignore")[:1]
        behind = text[max(0, place - 4) : place].decode("utf-8", "ignore")[-1:]
        return bool(ahead and behind) and behind != "'" and not (ahead.isspace() or behind.isspace())


def _ends_whole(text: bytes) -> bool:
    """Whether the last character of a part of a text is complete."""
    last = next((i for i in range(1, min(4, len(text)) + 1) if text[-i] & 0xC0 != 0x80), None)
    if last is None:
        return False
    lead = text[-last]
    return last == (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per Python worker."""
    return Codec(path)


def encode_tree(parts: list[list[int]], joined: Codec) -> list[int]:
    """Join the encodings of consecutive parts, pairs first, then pairs of pairs."""
    while len(parts) > 1:
        pairs = [joined.join(parts[i], parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
        parts = pairs + ([parts[-1]] if len(parts) % 2 else [])
    return parts[0] if parts else []


def _digests(ids: list[int], own: Codec) -> tuple[int, str, str]:
    listed = ",".join([own.text_of[i] for i in ids])
    decoded = own.decode(ids).encode()
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_texts(docs: DataFrame, path: str | None = None, text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """(text_key, tokens) of every distinct non-null text; tokens are little-endian uint32.

    ``text_key`` is the SHA-256 of the text, so a text that occurs often is encoded once.
    The leaves of one text meet again in one group, which is as large as that text.
    """
    path = path or vocabulary_path()
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    texts = texts.groupBy(F.sha2("text", 256).alias("text_key")).agg(F.any_value("text").alias("text"))
    return _encode_leaves(texts, path, leaf)


def _encode_leaves(texts: DataFrame, path: str, leaf: int) -> DataFrame:
    count = F.greatest(F.ceil(F.length("text") / leaf), F.lit(1))
    leaves = texts.select(
        "text_key", "text", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("number")
    ).select("text_key", "number", F.substring("text", F.col("number") * leaf + 1, F.lit(leaf)).alias("part"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            tokens = [np.array(own.encode(text), "<u4").tobytes() for text in batch["part"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["text_key"], batch["number"], pa.array(tokens, pa.binary())], names=["text_key", "number", "tokens"])

    def join(key, group: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, "<u4").tolist() for x in group.sort_values("number")["tokens"]]
        whole = encode_tree(parts, codec(path))
        return pd.DataFrame({"text_key": [key[0]], "tokens": [np.array(whole, "<u4").tobytes()]})

    spread = leaves.repartition("text_key", "number")
    encoded = spread.mapInArrow(encode, "text_key string, number int, tokens binary")
    return encoded.groupBy("text_key").applyInPandas(join, "text_key string, tokens binary")


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """Encode and decode each row's text; digests of the tokens and of the decoded text.

    Texts of up to ``leaf`` code points are encoded where they are read. Longer ones go
    through the tree by distinct text and join back by its SHA-256, where one side has a
    row per key. Null counts as empty and has no tokens. Every row gives a row, repeated
    ids and rows too; columns other than the two named are not read. An empty table gives
    no rows.
    """
    path = path or vocabulary_path()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = [_digests(own.encode(text.as_py()), own) for text in batch["text"]]
            yield _with_digests([batch["doc_id"]], ["doc_id"], rows)

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = [_digests(np.frombuffer(x.as_py(), "<u4").tolist(), own) for x in batch["tokens"]]
            yield _with_digests([batch["text_key"]], ["text_key"], rows)

    is_long = F.length("text") > leaf
    direct = narrow.where(~is_long).mapInArrow(short, f"doc_id {kind}, {DIGESTS}")
    keyed = narrow.where(is_long).select("doc_id", F.sha2("text", 256).alias("text_key"))
    tree = encode_texts(narrow.where(is_long), path, "text", leaf).mapInArrow(long, f"text_key string, {DIGESTS}")
    return direct.unionByName(keyed.join(tree, "text_key").drop("text_key"))


def _with_digests(columns: list, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    counts, ids, texts = zip(*rows) if rows else ((), (), ())
    arrays = [*columns, pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded."""
    return encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))

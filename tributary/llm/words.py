"""Words and word n-grams of many texts at once, as numpy arrays over Arrow buffers.

A word is a run of bytes other than space and 0x09-0x0D. Words are hashed to 64 bits, the
same on every executor: eight bytes at a time are mixed in by a one-to-one step, so words of
up to seven bytes never share a hash, and no pattern in longer ones makes them do so. (A
polynomial modulo 2**64 does not serve: whatever its base, long Thue-Morse words collide.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Rows are handled in slices of about so many bytes of text.
SLICE_BYTES = 2 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_PLACES = np.random.default_rng(20240501).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Words up to so many bytes are hashed side by side, longer ones each by xxHash.
SIDE_BY_SIDE = 32
_EIGHT = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, offsets from 0, bytes) of slices; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        after = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        after = min(max(after, first + 1), len(texts))
        own = offsets[first : after + 1]
        yield first, after, own - own[0], data[own[0] : own[-1]]
        first = after


class Words:
    """The words of a slice of texts.

    ``bounds[i]`` to ``bounds[i + 1]`` are the numbers of the words of text i; ``starts``
    and ``ends`` are byte positions in ``data``.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        self.offsets, self.data = offsets, data
        n = len(data)
        if n == 0:
            self.starts = self.ends = np.empty(0, np.int64)
            self.bounds = np.zeros(len(offsets), np.int64)
            return
        space = IS_SPACE[data]
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        before[offsets[:-1][offsets[:-1] < n]] = True
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(~space & after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash per word; with ``lower``, A-Z count as a-z."""
        data = LOWER[self.data] if lower else self.data
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # those that begin at each byte
        sizes = self.ends - self.starts
        out = sizes.astype(np.uint64) << np.uint64(56)
        open_ = np.flatnonzero(sizes <= SIDE_BY_SIDE)
        for place in range(0, SIDE_BY_SIDE, 8):
            open_ = open_[sizes[open_] > place]
            if not len(open_):
                break
            held = eights[self.starts[open_] + place] & _EIGHT[np.minimum(sizes[open_] - place, 8)]
            out[open_] = mix(out[open_] ^ held)
        for i in np.flatnonzero(sizes > SIDE_BY_SIDE):
            out[i] = xxhash.xxh3_64_intdigest(data[self.starts[i] : self.ends[i]])
        return out


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash per window of n words; a shorter, non-empty sequence counts as one window."""
    if len(hashes) == 0:
        return hashes
    size = min(n, len(hashes))
    windows = len(hashes) - size + 1
    total = np.full(windows, size, np.uint64)
    for place in range(size):
        total += hashes[place : place + windows] * _PLACES[place % 64]
    return mix(total)

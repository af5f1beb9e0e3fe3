"""Word hashes: equal for equal words only, wherever they stand."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tributary.llm import ngram_join, quality_rules
from tributary.llm.words import SIDE_BY_SIDE, Words, text_slices


def hashed(texts, lower=False):
    """The words of all texts with their hashes."""
    out = []
    for _, _, offsets, data in text_slices(pa.array(texts)):
        words = Words(offsets, data)
        flat = data.tobytes()
        own = [flat[a:b] for a, b in zip(words.starts, words.ends)]
        out += zip(own, words.hashes(lower).tolist())
    return out


def thue_morse(n):
    """Two words of 2**n letters that collide in every polynomial hash modulo 2**64."""
    one, two = "p", "q"
    for _ in range(n):
        one, two = one + two, two + one
    return one, two


@pytest.mark.parametrize("lower", [False, True])
def test_equal_words_and_no_others_share_a_hash(lower):
    choose = random.Random(8)
    words = ["".join(choose.choices("abABé\0", k=choose.randint(1, 80))) for _ in range(4000)]
    words += [word + "\0" * n for word in ("a", "ab", "a" * 31) for n in range(3)]
    words += [letter * n for letter in "ab" for n in range(1, 2 * SIDE_BY_SIDE)]
    texts = [" ".join(choose.sample(words, 50)) for _ in range(200)] + [" ".join(words), *words]
    found = {}
    for word, number in hashed(texts, lower):
        found.setdefault(number, set()).add(word.lower() if lower else word)
    assert all(len(group) == 1 for group in found.values())
    names = [word for group in found.values() for word in group]
    assert len(names) == len(set(names))


def test_thue_morse_words_differ():
    for n in (3, 5, 6, 10, 12):
        one, two = thue_morse(n)
        hashes = [number for _, number in hashed([one, two])]
        assert hashes[0] != hashes[1]


def test_hash_classes_are_even():
    """The bits that pick counters and hash classes are spread for short words as well."""
    numbers = np.array([number for _, number in hashed([" ".join(f"w{n}" for n in range(20_000))])], np.uint64)
    for bits in (numbers >> np.uint64(56), numbers & np.uint64(255)):
        counts = np.bincount(bits.astype(np.int64), minlength=256)
        assert counts.min() > 30 and counts.max() < 140


def test_texts_that_differ_in_a_long_word_are_not_linked(documents):
    one, two = thue_morse(10)
    rows = ngram_join.ngram_components(documents([(1, f"x y {one}"), (2, f"x y {two}"), (3, f"{one} p q {two} p q")]), 3, 90).collect()
    assert sorted((row["doc_id"], row["n_shingles"], row["component_id"]) for row in rows) == [(1, 1, 1), (2, 1, 2), (3, 4, 3)]


def test_long_words_are_no_repetition(documents):
    one, two = thue_morse(10)
    rows = quality_rules.host_rules(documents([(1, f"{one} p q {two} p q"), (2, f"{one} p q {one} p q")])).collect()
    assert {row["doc_id"]: row["n_repeat_words"] for row in rows} == {1: 0, 2: 6}


def test_very_long_texts(documents):
    """Beyond a slice: one long word, and many words."""
    long = "z" * 3_000_000
    many = " ".join(f"w{n}" for n in range(300_000))
    docs = documents([(1, long), (2, many), (3, many + " end"), (4, f"{long} a b")])
    rows = ngram_join.ngram_components(docs, 3, 90).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in rows} == {
        1: (1, 1), 2: (299_998, 2), 3: (299_999, 2), 4: (1, 4)
    }
    counts = {row["doc_id"]: row for row in quality_rules.host_rules(docs).collect()}
    assert (counts[1]["n_words"], counts[1]["word_chars"], counts[3]["n_words"]) == (1, 3_000_000, 300_001)
    assert counts[2]["n_repeat_words"] == 0

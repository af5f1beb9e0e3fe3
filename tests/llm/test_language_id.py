"""Language identification against greedy parsing by substring search, and on held-out text."""

import random

import numpy as np
import pytest

from tests.llm.conftest import SMALL
from tributary.llm import language_id

SCHEMA = "doc_id long, text string, lang string"


def greedy(reference, text):
    """Phrases of the text: each the longest piece of the reference that comes next."""
    phrases = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in reference and text[at : at + 1] in reference:
            size += 1
        at, phrases = at + size, phrases + 1
    return phrases


def parsed(reference, texts):
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    parser = language_id.Parser.build(reference)
    return np.rint(language_id.code_lengths([parser], offsets, data)[:, 0] / parser.bits).astype(int).tolist()


def test_phrases_equal_substring_search():
    choose = random.Random(3)
    word = lambda letters, n: bytes(choose.choices(letters, k=n))
    reference = word(b"abcd ", 200) + b"\0" + word(b"abce ", 150)
    texts = [word(b"abcde zz", choose.randint(0, 60)) for _ in range(300)]
    assert parsed(reference, texts) == [greedy(reference, text) for text in texts]


def test_long_texts_are_parsed_span_by_span(monkeypatch):
    choose = random.Random(4)
    reference = bytes(choose.choices(b"abc ", k=300))
    texts = [bytes(choose.choices(b"abcd ", k=n)) for n in (5000, 1, 1024, 1025, 0, 2048)]
    monkeypatch.setattr(language_id, "LANES", 3)
    span = language_id.SPAN
    cut = [[text[at : at + span] for at in range(0, len(text), span)] for text in texts]
    assert parsed(reference, texts) == [sum(greedy(reference, piece) for piece in pieces) for pieces in cut]


def test_normalized_text():
    texts = ["Ab,  1c!", "", "é-É", "  x"]
    data = "".join(texts).lower().encode()
    offsets = np.cumsum([0, *(len(text.lower().encode()) for text in texts)])
    offsets, flat = language_id.normalized(offsets, np.frombuffer(data, np.uint8))
    flat = flat.tobytes()
    assert [flat[a:b].decode() for a, b in zip(offsets, offsets[1:])] == ["ab c ", "", "é é", " x"]


def test_sample_is_bounded_and_counts_copies_once(spark):
    many = [(n, f"{n} eins zwei drei " * 20, "de") for n in range(400)]
    copies = [(n, "one two three four", "en") for n in range(900)]
    rows = spark.createDataFrame([*many, *copies, (1, None, "fr"), (2, "rien", None)], SCHEMA)
    references = language_id.learn(rows, max_pieces=50)
    assert sorted(references) == ["de", "en"]
    assert references["en"] == b"one two three four"
    assert 30 < references["de"].count(b"\0") + 1 <= 50
    assert references == language_id.learn(rows.repartition(7), max_pieces=50)


def test_edge_rows(spark):
    learned = spark.createDataFrame([(1, "the house and the garden", "en"), (2, "das haus und der garten", "de")], SCHEMA)
    references = language_id.learn(learned)
    rows = [(1, None), (2, ""), (3, "12 ,."), (4, "Das Haus, der Garten!"), (4, "Das Haus, der Garten!"), (None, "THE GARDEN"), (5, "the house " * 30_000), (6, "日本")]
    docs = spark.createDataFrame([(*row, "a", "b", 1.5) for row in rows], "doc_id long, text string, `lang_pred` string, c0 string, `odd.name` double")
    result = language_id.predict(docs, references)
    assert result.columns == ["lang_pred", "score", "doc_id", "text", "c0", "odd.name"]
    found = [(row["doc_id"], row["lang_pred"]) for row in result.collect()]
    # Equal languages: the first by name.
    assert found == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (None, "en"), (5, "en"), (6, "de")]
    assert all(row["score"] == 0.0 if row["lang_pred"] == "und" else 0.5 <= row["score"] <= 1 for row in result.collect())


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert language_id.learn(empty) == {}
    docs = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert [tuple(row) for row in language_id.predict(docs, {}).collect()] == [("und", 0.0, 1, "words")]
    assert language_id.predict(empty, {"en": b"the"}).collect() == []
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert language_id.query(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, folder):
    truth = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("doc_id", "lang", "crc32(cast(doc_id as string)) % 3 = 1 AS fold")
    rows = language_id.query(spark, folder).join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(row["held_out"] == row["fold"] for row in rows)
    held = [row["lang_pred"] == row["lang"] for row in rows if row["held_out"]]
    assert sum(held) >= 0.98 * len(held)

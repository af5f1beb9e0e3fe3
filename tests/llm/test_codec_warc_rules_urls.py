import hashlib
import random
import re

import pytest
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from tributary.llm import bpe_codec, quality_rules, url_filters, warc_archive

SPACE = "[^\x20\x09-\x0d]+"
PARTS = ["a", "the", " the", " ", "\n", "'", "'re", "é", "日本", "<|endoftext|>", "<|endof", "12", "-", "  ", "\t", "x" * 30, "ab" * 50, "-" * 40, " " * 20, "🙂", "9" * 40]


def library():
    import public_tokenizers

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.no_truncation()
    made.no_padding()
    return made


def test_joined_leaves_equal_the_whole_encoding():
    own, real, rng = bpe_codec.codec(bpe_codec.vocabulary_path()), library(), random.Random(3)
    for _ in range(400):
        some = rng.sample(PARTS, rng.choice([2, 4, len(PARTS)]))
        text = "".join(rng.choice(some) for _ in range(rng.choice([5, 60, 300])))
        leaf = rng.choice([3, 7, 20, 64])
        parts = [own.encode(text[i : i + leaf]) for i in range(0, len(text), leaf)]
        ids = real.encode(text, add_special_tokens=False).ids
        assert bpe_codec.encode_tree(parts, own) == ids
        assert own.decode(ids) == real.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("unit", ["abc", "日本語", "é-"])
def test_windows_stay_small_in_unsplit_text(monkeypatch, unit):
    own = bpe_codec.codec(bpe_codec.vocabulary_path())
    seen = []
    text = unit * 20_000
    parts = [own.encode(text[i : i + 5_000]) for i in range(0, len(text), 5_000)]
    monkeypatch.setattr(own, "encode", lambda t: seen.append(len(t)) or bpe_codec.Codec.encode(own, t))
    assert bpe_codec.encode_tree(parts, own) == bpe_codec.Codec.encode(own, text)
    assert max(seen) < 2_000


def test_codec_over_rows(documents):
    long = "über the rivers' 日本 <|endoftext|> " * 40
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, long), (4, long), (5, "x" * 300)]
    got = bpe_codec.encode_digests(documents(rows, "n_tokens"), leaf=50).collect()
    real = library()
    expected = []
    for doc, text in rows:
        ids = real.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((doc, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert bpe_codec.encode_digests(documents([])).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")


def test_archive_round_trip(spark, tmp_path):
    big, small = "ä" * 80, "x" * 99
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (9, "http://b", big), (9, "http://b", big), (None, "http://c", big), (1, "u", small), (2, "u", small), (7, "u", None), (8, "u", "")]
    warc_archive.write_archive(pages(spark, [(*r, "x") for r in rows]), str(tmp_path / "w"))
    stored = spark.read.parquet(str(tmp_path / "w" / "payloads"))
    assert stored.count() == stored.select("digest").distinct().count() == 3
    records = warc_archive.read_archive(spark, str(tmp_path / "w")).collect()
    assert len(records) == len(rows)
    for r in records:
        assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert block == bytes(r.payload)[:length] + b"\r\n\r\n"
        assert (length == len(r.payload)) == (r.record_type == "response")
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in records)
    assert kinds == [(0, "revisit", 3), (1, "response", None), (2, "response", None), (3, "response", None), (5, "revisit", 3), (7, "response", None), (8, "response", None), (9, "revisit", 3), (9, "revisit", 3)]
    assert {r.url for r in records if r.page_id == 5} == {"http://a/%0D%0AX: y"}


def test_archive_of_nothing_and_damage(spark, tmp_path):
    warc_archive.write_archive(pages(spark, []), str(tmp_path / "e"))
    assert warc_archive.read_archive(spark, str(tmp_path / "e")).count() == 0
    warc_archive.write_archive(pages(spark, [(1, "u", "page", "x")]), str(tmp_path / "d"))
    other = spark.createDataFrame([(hashlib.sha256(b"page").hexdigest(), bytearray(b"other"))], "digest string, payload binary")
    other.write.mode("overwrite").parquet(str(tmp_path / "d" / "payloads"))
    with pytest.raises(PySparkException):
        warc_archive.read_archive(spark, str(tmp_path / "d")).collect()


def count_by_hand(text):
    text = text or ""
    words = re.findall(SPACE, text)
    lines = [line for line in text.split("\n") if re.search(SPACE, line)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_rule_counts(documents):
    texts = [None, "", " \t\n", "a", "é b é b é b", "a b c a b c a", "x\nx\n \ny\nx", "<a> | #$%&*" * 9, "w1 w2\x85w3   w4", "ab " * 70, " ".join(f"w{i}" for i in range(60))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a"), (None, "b")]
    got = quality_rules.host_rules(documents(rows, "n_words")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in got), key=repr) == sorted(((d, *count_by_hand(t)) for d, t in rows), key=repr)
    assert quality_rules.host_rules(documents([])).count() == 0


def test_hosts_are_shrunk_and_judged(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}$$$" for i in range(60))
    rows = [(i, good, f"h{i % 9}") for i in range(180)] + [(1000 + i, bad, "junk") for i in range(50)] + [(2000, good, "junk"), (2001, bad, "tiny"), (2002, bad, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.host_rules(docs).collect()}
    assert all(kept[i] for i in range(180))
    assert not kept[1000] and not kept[2000]  # the host fails, with all it has
    assert kept[2001]  # one bad page alone says little about a host
    assert kept[2002]  # no host, no host verdict
    assert quality_rules.beta_prior(0.2, 0.01) == pytest.approx((3.0, 12.0))
    assert quality_rules.beta_prior(None, None) == (0.0, 10.0)


def active_by_hand(url, at, entries):
    host = re.match(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", (url or "").lower())
    host = host[1].removesuffix(".") if host else None
    keys = set()
    if url is not None:
        keys.add("url:" + url.split("#")[0])
    if host:
        labels = host.split(".")
        keys |= {"host:" + host} | {"domain:" + ".".join(labels[-k:]) for k in range(1, len(labels) + 1)}
    found = []
    for key in keys:
        past = [e for e in entries if e[0] == key and None not in e and e[1] <= at] if at is not None else []
        if past:
            last = max(past, key=lambda e: (e[1], e[3]))
            found += [last[3]] if last[2] else []
    return len(found), min(found, default=None)


def test_entries_active_at_fetch_time(spark):
    rng = random.Random(1)
    names = ["domain:b.com", "host:a.b.com", "url:http://a.b.com/x", "domain:com", "host:c.org", None]
    entries = [(rng.choice(names[:-1]), rng.randrange(100), rng.random() < 0.6, i) for i in range(300)] + [(None, 1, True, 900), ("host:c.org", None, True, 901), ("host:c.org", 5, None, 902)]
    urls = ["http://a.b.com/x", "https://u@A.B.com.:80/x#f", "http://c.org", "ftp://d.net/", "no url", "", None]
    rows = [(i, rng.choice(urls), rng.choice([None, *range(-5, 110)]), "x") for i in range(400)]
    captures = spark.createDataFrame(rows + rows[:20], "page_id long, url string, fetched_at long, blocked string")
    listed = spark.createDataFrame(entries, "pattern string, at long, listed boolean, entry_id long")
    got = url_filters.filter_urls(captures, listed).collect()
    expected = [(i, url, at, *active_by_hand(url, at, entries)) for i, url, at, _ in rows + rows[:20]]
    assert sorted(((r.page_id, r.url, r.fetched_at, r.n_active, r.first_entry) for r in got), key=repr) == sorted(expected, key=repr)
    assert all(r.blocked == (r.n_active > 0) for r in got)
    assert url_filters.filter_urls(captures, listed.limit(0)).where("blocked").count() == 0
    assert url_filters.filter_urls(captures.limit(0), listed).count() == 0

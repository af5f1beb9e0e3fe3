import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import line_dedup, ngram_join, packing, pii, quality_classifier, vector_index
from tributary.llm.components import components
from tributary.llm.sampling import hashed_sample
from tributary.sources.scratch import stored

FLAT = pii.Model(0.0, (), {})


def words_of(rng, n, alphabet=200):
    return " ".join(f"w{rng.randrange(alphabet)}" for _ in range(n))


def components_by_hand(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# --- components ---------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3), (301, 300), (300, 301), (302, 301)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == components_by_hand({i for link in real for i in link}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- n-gram join --------------------------------------------------------------------


def jaccard_by_hand(rows, n, percent):
    sets = {}
    for doc, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
        sets[doc] = grams
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]
    ]
    found = components_by_hand(sets, links)
    return sorted((doc, len(sets[doc]), found[doc]) for doc in sets)


def near_copies(rng):
    rows = []
    for _ in range(12):
        base = words_of(rng, rng.choice([2, 30, 120, 400])).split()
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                if copy:
                    copy[rng.randrange(len(copy))] = f"e{rng.randrange(50)}"
            rows.append(" ".join(copy))
    rows += [None, "", " \n", "one", "ONE", "one two", "é É", rows[0], rows[0], words_of(rng, 300) + " " + rows[1]]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_ngram_components_equal_all_pairs(documents, monkeypatch, n, percent):
    rng = random.Random(n)
    rows = near_copies(rng)
    got = sorted(map(tuple, ngram_join.ngram_components(documents(rows, "n_shingles"), n, percent).collect()))
    assert got == jaccard_by_hand(rows, n, percent)


def test_large_blocks_are_cut_without_losing_links(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_DOCS", 7)
    rng = random.Random(9)
    base = words_of(rng, 80).split()
    rows = []
    for i in range(60):
        copy = list(base) + [f"x{k}" for k in range(rng.randrange(12))]
        copy[rng.randrange(len(copy))] = f"e{i}"
        rows.append((i, " ".join(copy)))
    got = sorted(map(tuple, ngram_join.ngram_components(documents(rows), 3, 90).collect()))
    assert got == jaccard_by_hand(rows, 3, 90)


def test_ngram_edge_rows(documents):
    text = "a b c d e f"
    got = ngram_join.ngram_components(documents([(5, text), (5, text), (None, text), (None, "q r s"), (7, text.upper())]), 3, 90).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(5, 4, 5), (5, 4, 5), (None, 4, 5), (None, 1, None), (7, 4, 5)], key=repr)
    assert ngram_join.ngram_components(documents([]), 3, 90).count() == 0
    kept = ngram_join.keep_one(documents([(5, text), (7, text), (8, "z"), (None, text)])).collect()
    assert {r.doc_id for r in kept} == {5, 8, None} and kept[0].n_lines == "x"


def test_screening_keeps_every_link(monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 1_400, dtype=np.uint64)
    sets = []
    for size in (5, 60, 1_000, 1_040, 1_300):
        for _ in range(6):
            own = base[:size].copy()
            own[rng.random(size) < 0.04] = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
            sets += [np.unique(own), np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))]
    sizes = np.array([len(s) for s in sets])
    maybe = ngram_join.screen([ngram_join.shape_of(s) for s in sets], sizes, 90)
    linked = ngram_join.overlaps(sets, 90)
    assert linked.sum() > 20 and not (linked & ~maybe).any()
    unrelated = [i for i in range(1, len(sets), 2) if sizes[i] >= 60]
    assert not maybe[unrelated].any() and not maybe[:, unrelated].any()


def test_tiles_are_screened_side_by_side(monkeypatch):
    """Many tiles at once, from batches that cut them anywhere, give what each gives alone."""
    rng = np.random.default_rng(6)
    base = [rng.integers(0, 1 << 63, size, dtype=np.uint64) for size in (12, 300, 1_500)]
    tiles = []
    for _ in range(60):
        made = [base[rng.integers(3)] for _ in range(rng.integers(1, 8))]
        tiles.append([np.unique(own[rng.random(len(own)) < rng.choice([0.8, 0.97, 1.0])]) for own in made])
    shapes = [[ngram_join.shape_of(own) for own in sets] for sets in tiles]
    rows = [(t, i, len(tiles[t][i]), shapes[t][i]) for t in range(len(tiles)) for i in range(len(tiles[t]))]
    table = pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows))], names=["tile", "i", "n", "shape"])
    cuts = [0, 1, 2, 30, 31, 90, len(rows)]
    batches = [table.slice(a, b - a) for a, b in itertools.pairwise(cuts)]
    expected = set()
    for t, sets in enumerate(tiles):
        maybe = ngram_join.screen(shapes[t], np.array([len(own) for own in sets]), 90)
        for i, root in components_by_hand(range(len(sets)), zip(*map(np.ndarray.tolist, np.nonzero(maybe)))).items():
            if maybe[i].any() or maybe[:, i].any():
                expected.add((t, i, root))
    for pairs in (5, 1 << 15):
        monkeypatch.setattr(ngram_join, "PAIRS", pairs)
        got = []
        for held, starts in ngram_join.whole_tiles(iter(batches), ["tile"]):
            names, places = held["tile"].to_pylist(), held["i"].to_pylist()
            assert starts.tolist() == [i for i in range(len(held)) if places[i] == 0]
            for chosen, roots in ngram_join.screened(held["shape"], held["n"].to_numpy(), starts, 90):
                got += [(names[i], places[i], places[root]) for i, root in zip(chosen, roots)]
        assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 50
    assert not list(ngram_join.whole_tiles(iter([]), ["tile"]))


def test_counters_tell_rare_ngrams_apart(documents):
    """Of 300,000 different words, each used once, most have a counter of their own."""
    rows = [(i, " ".join(f"w{k}" for k in range(i * 1_000, (i + 1) * 1_000))) for i in range(300)]
    sketch = ngram_join.frequency_sketch(documents([*rows, (300, None)]), 1)
    assert sketch.sum() == 300_000 and (sketch == 1).sum() > 0.7 * 300_000


def test_overlap_products_agree_with_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(40)]
    linked = ngram_join.overlaps(sets, 60)
    for i, j in itertools.combinations(range(40), 2):
        both, either = len(np.intersect1d(sets[i], sets[j])), len(np.union1d(sets[i], sets[j]))
        assert linked[i, j] == (100 * both >= 60 * either)


def test_a_full_tile_takes_little_memory():
    """The sets of a tile with all pairs linked; a matrix of long numbers alone has 11 MB."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(base[rng.random(200) < 0.99]) for _ in range(1_200)]
    tracemalloc.start()
    linked = ngram_join.overlaps(sets, 80)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert linked.sum() == 1_200 * 1_199 // 2 and most < 40 << 20


# --- line dedup ---------------------------------------------------------------------


def dedup_by_hand(rows):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\r\x0b\x0c"))
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(held[key(line)]) < 3 or doc == max(held[key(line)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows(rng):
    pool = [f"this is the shared line number {i}" for i in range(12)] + ["short", "", "é" * 19, "É" * 20, "\t Padded line of twenty ", " nbsp is no ascii space here"]
    rows = []
    for doc in range(50):
        lines = [rng.choice(pool) if rng.random() < 0.5 else words_of(rng, 6) for _ in range(rng.randrange(8))]
        rows.append((doc, "\n".join(line.upper() if rng.random() < 0.2 else line for line in lines)))
    return rows + [(100, None), (101, ""), (102, "\n\n"), (3, rows[3][1]), (103, pool[0] + "\n" + pool[0] + "\nend")]


def cells(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=repr)


def test_line_dedup_equals_brute_force(documents):
    rows = line_rows(random.Random(4))
    assert cells(line_dedup.dedup_lines(documents(rows))) == dedup_by_hand(rows)
    assert line_dedup.dedup_lines(documents([])).count() == 0
    line = "this line is held by rows without an id"
    assert {r.n_dropped for r in line_dedup.dedup_lines(documents([(None, line)] * 4)).collect()} == {0}


def test_insertions_and_deletions_are_reversible(spark, documents):
    rows = line_rows(random.Random(5))
    first, second = rows[:30], [r for r in rows[30:] if r[0] != 3]
    start = line_dedup.insert(line_dedup.empty_state(spark), documents(first))
    grown = line_dedup.insert(start, documents(second))
    assert cells(line_dedup.drop_repeated_lines(documents(first + second), grown)) == dedup_by_hand(first + second)
    back = line_dedup.delete(grown, documents(second))
    assert cells(line_dedup.drop_repeated_lines(documents(first), back)) == dedup_by_hand(first)
    same = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert same(back.refs) == same(start.refs) and same(back.counts) == same(start.counts)
    again = line_dedup.insert(grown, documents(second))
    assert same(again.counts) == same(grown.counts)


def test_changes_touch_rows_in_proportion(spark, documents, monkeypatch):
    """Documents inserted into a large state: what is written is theirs, and nothing else."""
    lines = [f"line number {n} of the shared ones" for n in range(400)]
    rng = random.Random(6)
    rows = [(i, "\n".join([*rng.sample(lines, 4), f"own line of document {i}, held by nobody else"])) for i in range(600)]
    new = [(1000 + i, "\n".join([*rng.sample(lines, 4), f"own line of new document {i}"])) for i in range(6)]
    state = line_dedup.insert(line_dedup.empty_state(spark), documents(rows))
    written = []

    def counting(df, purpose, replaces=None):
        found = stored(df, purpose, replaces)
        written.append((purpose, found.count()))
        return found

    monkeypatch.setattr(line_dedup, "stored", counting)
    grown = line_dedup.insert(state, documents(new))
    assert sum(n for purpose, n in written if purpose != "filters") <= 3 * 6 * 5
    assert cells(line_dedup.drop_repeated_lines(documents(rows + new), grown)) == dedup_by_hand(rows + new)
    written.clear()
    back = line_dedup.delete(grown, documents(new))
    assert sum(n for purpose, n in written if purpose != "filters") <= 4 * 6 * 5
    assert cells(line_dedup.drop_repeated_lines(documents(rows), back)) == dedup_by_hand(rows)


def test_shards_follow_the_number_of_keys(spark, documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 20)
    monkeypatch.setattr(line_dedup, "LAYERS", 2)
    rng = random.Random(7)
    lines = [f"line number {n} of the shared ones" for n in range(120)]
    state, rows, shards = line_dedup.empty_state(spark), [], []
    for turn in range(4):
        more = [(turn * 100 + i, "\n".join(rng.sample(lines[: 40 * (turn + 1)], 20))) for i in range(10)]
        rows += more
        state = line_dedup.insert(state, documents(more))
        shards.append(state.shards)
        held = state.counts.where(f"n_docs >= {state.min_docs}").select("key").collect()
        assert state.held == len(held) <= state.shards * 20
        assert state.filters.count() <= state.shards
    assert shards[0] < shards[-1]
    assert cells(line_dedup.drop_repeated_lines(documents(rows), state)) == dedup_by_hand(rows)
    gone, kept = rows[:25], rows[25:]
    state = line_dedup.delete(state, documents(gone))
    assert cells(line_dedup.drop_repeated_lines(documents(kept), state)) == dedup_by_hand(kept)


def test_clashing_names_pass_unchanged(spark):
    line = "a line that three documents share"
    rows = [(i, f"{line}\nown {i}", "kept", "kept", "kept", "kept") for i in range(4)] + [(None, line, "kept", "kept", "kept", "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, `drop` string, gone string, `a.b` string")
    for found in (line_dedup.dedup_lines(docs), ngram_join.keep_one(docs, 3, 50)):
        assert [name for name in found.columns if name in docs.columns] == docs.columns
        assert {(r["id"], r["drop"], r["gone"], r["a.b"]) for r in found.collect()} == {("kept",) * 4}
    assert [r.n_dropped for r in line_dedup.dedup_lines(docs).orderBy(F.asc_nulls_last("doc_id")).collect()] == [1, 1, 1, 0, 0]
    assert ngram_join.keep_one(docs, 3, 50).count() == 2


def test_a_very_long_text_loses_its_lines(documents):
    line = "this line is in three documents at least"
    rows = [(1, line), (2, line), (3, "\n".join(f"filler {n} " * 3 + ("\n" + line) * (n % 9 == 0) for n in range(60_000)) + "é" * 2_000_000), (4, line)]
    assert cells(line_dedup.dedup_lines(documents(rows))) == dedup_by_hand(rows)


def test_cuckoo_filter_holds_inserts_and_deletes():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(5_000)]
    made = line_dedup.CuckooFilter.of(keys[:3_000])
    assert made.contains(keys[:3_000]).all()
    assert made.contains(keys[3_000:]).mean() < 0.01
    for key in keys[:1_500]:
        made.delete(key)
    assert made.contains(keys[1_500:3_000]).all()
    assert made.contains(keys[:1_500]).mean() < 0.01
    small = line_dedup.CuckooFilter(np.zeros((4, 4), np.uint16))
    assert not all(small.insert(key) for key in keys[:40])


# --- PII ----------------------------------------------------------------------------

TEXTS = [
    None, "", "no data", "mail a.b+c@x-y.example.com, or @x.y or a@b", "a@b.c@d.e.f", "1.2.3.4 and 1.2.3.4.5.6.7.8 and 256.1.1.1 001.02.3.255",
    "card 4111 1111 1111 1111 x4111-1111-1111-1112 41111111111111111111", "call +1 (555) 555-1234. or +12 or +1-234-567-890-123-4567",
    "é@b.cc ü1.1.1.1", "..%@a.b-.c", "9" * 5_000 + ".1.1.1", "@" * 200, "a" * 50 + "@b" * 50, "+1 " * 100, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
]


def base_by_hand(text):
    text = text or ""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([ -]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def test_base_spans_equal_the_patterns(documents):
    rng = random.Random(8)
    alphabet = "ab1239.@+-% ()é"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3_000)]
    for text in texts:
        assert pii.find(text or "", FLAT)[0] == base_by_hand(text)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3]), (3, TEXTS[3])]
    got = pii.find_spans(documents(rows, "spans"), FLAT).collect()
    listed = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    assert sorted(((r.doc_id, r.base_spans) for r in got), key=repr) == sorted(((d, listed(base_by_hand(t))) for d, t in rows), key=repr)
    assert pii.find_spans(documents([]), FLAT).count() == 0


def test_trees_learn_and_thresholds_hold_the_precision():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3_000, len(pii.FEATURES)))
    real = ((rows[:, 3] > 0.2) & (rows[:, 7] < 0.5)).astype(float)
    model = pii.Model(*pii.boost(rows[:2_000], real[:2_000]), {})
    scores = model.score(rows[2_000:])
    assert ((scores > 0.5) == (real[2_000:] > 0)).mean() > 0.95
    threshold = pii.calibrate(scores, real[2_000:], 0.99)
    assert real[2_000:][scores >= threshold].mean() >= 0.99
    assert pii.calibrate(np.array([0.9, 0.8]), np.array([0.0, 0.0])) > 1
    assert pii.calibrate(np.array([]), np.array([])) > 1


def test_training_adds_likely_spans_and_keeps_the_base(documents):
    rng = random.Random(2)

    def card(real):
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        digits += next(d for d in "0123456789" if pii.luhn(digits + d) == real)
        return digits

    texts = [f"pay with {card(rng.random() < 0.6)} or call +1 (555) 555-{rng.randrange(1000, 9999)} soon" for _ in range(900)]
    texts += [f"call +1{rng.randrange(99)} for it" for _ in range(300)]
    model = pii.train(documents(list(enumerate(texts))))
    assert model.trees and set(model.thresholds) == set(pii.KINDS)
    text = f"card {card(True)} tel 1 (555) 555-1234 now"
    base, every = pii.find(text, model)
    assert set(base) <= set(every) and base == base_by_hand(text)
    spelled = "pay with 4111 / 1111 / 1111 / 1111 or"
    assert pii.find(spelled, pii.Model(5.0, (), {"card": 0.5}))[1] == [("card", 9, 34)]
    empty = pii.train(documents([]))
    assert empty.trees == () and pii.find(spelled, empty)[1] == []


def test_spans_inside_failed_matches_are_found(documents):
    rng = random.Random(3)

    def card():
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return digits + next(d for d in "0123456789" if pii.luhn(digits + d))

    def fails(number):
        return number[:-1] + str((int(number[-1]) + 1) % 10)

    def phone():
        return f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    def ip():
        return ".".join(str(rng.randrange(1, 256)) for _ in range(4))

    texts = [f"pay with {card()} or {fails(card())} now, call {phone()} soon, at host {ip()} or {ip()} too" for _ in range(300)]
    texts += [f"write to some.one{rng.randrange(100)}@mail{rng.randrange(10)}.example.com about it" for _ in range(300)]
    model = pii.train(documents(list(enumerate(texts))))

    def found(text):
        base, every = pii.find(text, model)
        assert base == base_by_hand(text) and set(base) <= set(every)
        return {(kind, text[start:end]) for kind, start, end in every}

    a, b = "7536784127813050", "4845168114407329"
    assert found(f"see {a} {b} there") == {("card", a), ("card", b)}
    assert found(f"see {a} {fails(b)} there") == {("card", a)}
    near = "+1 (843) 555-7672", "170.106.47.218"
    assert found(f"call {near[0]} {near[1]} there") == {("phone", near[0]), ("ip", near[1])}
    assert found(f"call {near[0]}.{near[1]} there") == {("phone", near[0]), ("ip", near[1])}
    assert found("call 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 there") == set()
    spelled = "to some.one AT mail3 DOT example (Dot) com."
    assert [spelled[s:e] for kind, s, e in pii.loose_matches(spelled) if kind == "email"] == [spelled[3:-1]]


def test_all_examples_train_and_calibrate(documents, monkeypatch):
    monkeypatch.setattr(pii, "TREES", 8)
    rng = random.Random(11)

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    texts = [f"pay 4{number(15)} or {number(16)}, call +1 (555) {number(3)}-{number(4)} at {rng.randrange(300)}.2.3.{rng.randrange(300)}" for _ in range(2_200)]
    examples = {}
    for text in texts:
        for mark, *known in pii.described(text):
            examples[mark] = min(examples.get(mark, known), known)
    assert len(examples) > 22_000
    held = np.array([int(mark[-2:], 16) % 5 == 0 for mark in examples])
    real = np.array([real for real, _ in examples.values()], float)
    rows = np.array([x for _, x in examples.values()])
    base, trees = pii.boost(rows[~held], real[~held])
    scores = pii.Model(base, trees, {}).score(rows)
    # Copies count once, and neither order nor partitions matter.
    model = pii.train(documents(list(enumerate(texts[::-1] + texts[:200]))).repartition(5))
    assert model.base == base and len(model.trees) == len(trees) == pii.TREES
    assert all((a == b).all() for own, other in zip(model.trees, trees) for a, b in zip(own, other))
    for number, kind in enumerate(pii.KINDS):
        own = held & (rows[:, number] == 1) & (rows[:, pii.LOOSE] == 1)
        assert model.thresholds[kind] == pii.calibrate(scores[own], real[own])
    assert min(model.thresholds.values()) < 1


def test_thresholds_of_many_scores_equal_those_in_memory(spark):
    rng = np.random.default_rng(4)
    rows = [(kind, round(float(rng.beta(5, 0.3)), 3 + 6 * kind), 1) for kind in range(3) for _ in range(2_000)]
    rows = [(kind, score, n, int(rng.random() < score**0.2)) for kind, score, n in rows]
    rows += [(0, 1.0, 50, 50), (0, 0.0, 3, 0)]
    got = pii.thresholds_of(spark.createDataFrame(rows, "kind int, score double, total long, real long"), 0.97)
    for kind in range(4):
        scores = np.array([score for k, score, n, _ in rows if k == kind for _ in range(n)])
        real = np.array([float(i < r) for k, _, n, r in rows if k == kind for i in range(n)])
        assert got[pii.KINDS[kind]] == pii.calibrate(scores, real, 0.97)


def test_redaction_keeps_the_rest(documents):
    rows = [(1, "to a@b.cc, +1 (555) 555-1234."), (2, None), (3, "")]
    got = {r.doc_id: r.text for r in pii.redact(documents(rows), FLAT).collect()}
    assert got == {1: "to [EMAIL], [PHONE].", 2: None, 3: ""}
    assert pii.redact_text("abcdefgh", [("ip", 1, 4), ("card", 2, 6)]) == "a[IP]gh"


# --- packing ------------------------------------------------------------------------


def check_pieces(rows, texts, window):
    import public_tokenizers

    real = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    real.no_truncation()
    real.no_padding()
    expected = sorted((d, real.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in texts)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, ids in expected:
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or at < window and at & (at - 1) == 0


def test_words_are_tokenized_as_the_library_does():
    own = packing.WordTokenizer(packing.vocabulary_path())
    rng = random.Random(7)
    parts = ["the", "Straße", "ÉTÉ", "don't", "we'LL", "x9", "--", "日本", "e\u0301", "İ", "ŉ", "<|endoftext|>", "<|", "\x85", "\xa0", "\x1c", "\x00", "ÿ", "½", "²", "A.B@c", "'"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", "\n"]) for _ in range(rng.randrange(1, 9)))
        assert np.frombuffer(own.encode(text.encode()), "<u2").tolist() == own.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("shard", [40, 1_000_000])
def test_every_token_is_packed_once(documents, shard):
    rng = random.Random(6)
    texts = [(i, words_of(rng, rng.choice([0, 1, 5, 40, 150]), 30)) for i in range(80)]
    texts += [(100, None), (101, ""), (102, "Ünï’s İ ﬁ é <|endoftext|> don't a b \x85c"), (103, texts[0][1])]
    rows = packing.pack_documents(documents(texts, "length"), window=64, shard_tokens=shard).collect()
    check_pieces(rows, texts, 64)
    assert packing.pack_documents(documents([])).count() == 0


def test_rows_without_or_with_the_same_id_are_packed_each(documents):
    rows = packing.pack_documents(documents([(None, "a b"), (1, "a b"), (1, "a b")]), window=16).collect()
    assert sorted(((r.doc_id, r.length) for r in rows), key=repr) == [(1, 3), (1, 3), (None, 3)] or sum(r.length for r in rows) == 9


def windows_of(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.doc_id, r.start, r.length))
    return sorted(sorted(own) for own in sequences.values())


def test_windows_do_not_depend_on_the_session(spark, documents):
    rng = random.Random(16)
    texts = [(i, words_of(rng, rng.choice([5, 40, 150]), 60)) for i in range(120)]
    docs = documents(texts)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    found = []
    try:
        for partitions in (4, 200, 2000):
            spark.conf.set(setting, partitions)
            found.append(windows_of(packing.pack_documents(docs, window=64, shard_tokens=900).collect()))
    finally:
        spark.conf.set(setting, before)
    assert found[0] == found[1] == found[2]
    sizes = [sum(piece[3] for piece in own) for own in found[0]]
    # Several shards and rounds, and only the last tokens of all are not in a full window.
    assert sum(sizes) > 5 * 900 and sum(size for size in sizes if size != 64) < 64


def test_copies_of_one_text_are_many_shards_work(documents):
    texts = [(i, words_of(random.Random(3), 30, 60)) for i in range(200)] + [(7, words_of(random.Random(3), 30, 60))] * 100
    rows = packing.pack_documents(documents(texts), window=64, shard_tokens=600).collect()
    assert len({r.sequence_id >> 24 for r in rows}) > 10
    assert sum(r.length for r in rows) == 300 * rows[0].doc_tokens
    for own in windows_of(rows):
        assert [piece[0] for piece in own] == [sum(p[3] for p in own[:i]) for i in range(len(own))]


def test_long_texts_are_packed_whole(documents):
    texts = [(1, "word " * 200_000), (2, "w" * 50_000), (3, "a b c")]
    check_pieces(packing.pack_documents(documents(texts)).collect(), texts, 4096)


def test_windows_hold_lexical_neighbours():
    rng = np.random.default_rng(1)
    texts = [np.concatenate([rng.integers(100 * (i % 2), 100 * (i % 2) + 100, 15)]).astype(np.uint16) for i in range(40)]
    sequences, left = packing.pack_shard(texts, 30)
    assert not left and sum(len({t % 2 for t, _, _ in s}) == 1 for s in sequences) >= 18


# --- quality classifier -------------------------------------------------------------


def test_classifier_ranks_held_out_texts(spark):
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(600):
        text = words_of(rng, rng.randrange(20, 120), 500)
        good = rng.random() < 0.7
        rows.append((i, text if good else " ".join(w + "$$$" for w in text.split()), "x"))
        if i % 2:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows + [(1000, None, "x"), (1001, "", "x"), (None, "a", "x"), (3, "a b", "x")], "doc_id long, text string, score string")
    marked = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality_classifier.train(docs, marked)
    assert 0.6 < model.prior < 0.8
    got = quality_classifier.score(docs, model).collect()
    assert len(got) == 604 and all(0 <= r.score <= 1 for r in got)
    scores = {r.doc_id: r.score for r in got}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = np.mean([(scores[i] >= quality_classifier.THRESHOLD) == y for i, y in held])
    assert right > 0.95
    assert len({r.score for r in got if not r.text}) == 1
    again = quality_classifier.train(docs.repartition(3), marked)
    assert all(np.allclose(a, b) for a, b in zip(again.weights, model.weights))


@pytest.mark.parametrize("prior", [0.1, 0.6, 0.95])
def test_risk_descends_by_its_gradient(prior):
    """Against finite differences; below zero the descent is that of minus the bad risk."""
    rng = np.random.default_rng(int(100 * prior))
    signs = set()
    for trial in range(6):
        xp, xu = rng.normal(1, 1, (9, 5)), rng.normal(0, 1, (13, 5))
        weights = [rng.normal(0, 1, (5, 4)), rng.normal(0, 1, 4), rng.normal(0, 2, 4), rng.normal(0, 2, 1)]

        def parts():
            hidden_p, out_p = quality_classifier._forward(xp, weights)
            _, out_u = quality_classifier._forward(xu, weights)
            bad = np.logaddexp(0, out_u).mean() - prior * np.logaddexp(0, out_p).mean()
            return prior * np.logaddexp(0, -out_p).mean(), bad

        total, grads = quality_classifier.risk(xp, xu, weights, prior)
        good, bad = parts()
        assert total == pytest.approx(good + max(0, bad))
        signs.add(bad >= 0)
        wanted = (lambda: sum(parts())) if bad >= 0 else (lambda: -parts()[1])
        for weight, grad in zip(weights, grads):
            for place in np.ndindex(weight.shape):
                before = weight[place]
                weight[place] = before + 1e-6
                above = wanted()
                weight[place] = before - 1e-6
                slope = (above - wanted()) / 2e-6
                weight[place] = before
                assert grad[place] == pytest.approx(slope, abs=1e-5)
    assert prior < 0.9 or signs == {True, False}


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_the_prior_is_found_without_negatives(share):
    rng = np.random.default_rng(4)
    width = len(quality_classifier.FEATURES)
    good, bad = (lambda n: rng.normal(0, 1, (n, width))), (lambda n: rng.normal(0, 1, (n, width)) + 1.2 * (np.arange(width) < 6))
    unlabelled = np.concatenate([good(round(4000 * share)), bad(4000 - round(4000 * share))])
    assert quality_classifier.mixture_share(good(2500), unlabelled) == pytest.approx(share, abs=0.06)


def test_positive_labels_alone_reject_bad_documents(spark):
    """The given tables with the zeros taken out of the labels."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    outside = labels.where("crc32(cast(doc_id as string)) % 5 != 0")
    share = outside.agg(F.avg("quality")).first()[0]
    model = quality_classifier.train(docs, labels.where("quality = 1"))
    assert abs(model.prior - share) <= 0.05
    held = docs.join(labels.where("crc32(cast(doc_id as string)) % 5 = 0"), "doc_id").select("text", "quality")
    rows = quality_classifier.score(held, model).collect()
    assert np.mean([(r.score >= quality_classifier.THRESHOLD) == r.quality for r in rows]) > 0.95


def test_samples_hold_one_row_of_a_group_of_copies(spark, monkeypatch):
    rows = spark.createDataFrame([(k, k * 7) for k in range(1_000)], "k long, v long")
    first = hashed_sample(rows, 50, "k")
    hot = spark.createDataFrame([(first[0].k, v) for v in range(500, -1, -1)], "k long, v long")
    sample = hashed_sample(rows.union(hot), 50, "k")
    assert [r.k for r in sample] == [r.k for r in first] and 30 <= len(sample) <= 50
    assert sample[0].v == 0 and [r.v for r in sample[1:]] == [r.v for r in first[1:]]
    fitted = []
    monkeypatch.setattr(quality_classifier, "fit", lambda positive, unlabelled, prior: fitted.append((len(positive), len(unlabelled))))
    docs = rows.union(rows).union(hot).select(F.col("k").alias("doc_id"), F.concat(F.lit("text "), F.col("v").cast("string")).alias("text"))
    quality_classifier.train(docs, rows.select(F.col("k").alias("doc_id"), F.lit(1).alias("quality")), max_positive=40, max_unlabelled=60)
    assert 20 <= fitted[0][0] <= 40 and 30 <= fitted[0][1] <= 60


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(100)], "doc_id long, text string")
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame([(i, 1) for i in held], "doc_id long, quality int")
    model = quality_classifier.train(docs, labels)
    assert model.prior == 0.5 and {r.score for r in quality_classifier.score(docs, model).collect()} == {0.5}
    empty = docs.limit(0)
    assert quality_classifier.score(empty, quality_classifier.train(empty, labels.limit(0))).count() == 0


# --- vectors ------------------------------------------------------------------------


def vectors_by_hand(rows, bound):
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8:
            good[i] = np.array(v) / np.linalg.norm(v)
    links = [(a, b) for a, b in itertools.combinations(good, 2) if good[a] @ good[b] >= bound]
    found = components_by_hand([i for i, _ in rows], links)
    return [(i, sum(i in link for link in links), found[i], found[i] == i) for i, _ in rows]


def test_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "TILE", 9)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] + rng.normal(size=8) * 0.12)]) for i in range(120)]
    rows += [(200 + k, rows[0][1]) for k in range(3)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [float("nan")] * 8), (304, [1.0, None] + [0.0] * 6), (305, [float("inf")] * 8), (306, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("kept", vector_index.F.lit("x"))
    got = sorted(map(tuple, vector_index.near_vectors(df).collect()))
    expected = sorted(vectors_by_hand(rows, 0.95))
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in expected)
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert all(a[1] <= b[1] for a, b in zip(got, expected))
    assert sum(a == b for a, b in zip(got, expected)) >= 0.9 * len(rows)
    assert vector_index.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_every_length_are_linked(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(20)]
    rows += [(100, [1.0, 2.0]), (101, [1.0, 2.0]), (102, [1.0, 2.1]), (103, [2.0, -1.0]), (104, [3.0]), (105, [4.0]), (106, [1.0, 2.0, 3.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {i: got[i] for i in range(100, 107)} == {100: (2, 100), 101: (2, 100), 102: (2, 100), 103: (0, 103), 104: (1, 104), 105: (1, 104), 106: (0, 106)}
    assert len(got) == len(rows)


def test_small_groups_count_beside_a_hot_one():
    turn = lambda degrees: [np.cos(np.radians(degrees)), np.sin(np.radians(degrees)), 0.0, 0.0]
    sample = np.array([turn(0)] * 510 + [turn(40), turn(50)] + [turn(0)] * 90)
    index = vector_index.MultiIndex(np.eye(2), np.zeros((1, 2)), 0.0)
    a, b = index.distances(sample[510:512])
    assert vector_index.linked_reach(index, sample, 0.95, 0.999) == pytest.approx(a[0, 1] + b[0, 0])


def test_traversal_visits_cells_by_distance():
    rng = np.random.default_rng(3)
    a, b = rng.random(5), rng.random(7)
    order = list(vector_index.traverse(a, b, 1.2))
    sums = (a[:, None] + b[None, :]).ravel()
    assert order == [int(i) for i in np.argsort(sums, kind="stable") if sums[i] <= 1.2]
    assert len(list(vector_index.traverse(a, b, -1.0))) == 1

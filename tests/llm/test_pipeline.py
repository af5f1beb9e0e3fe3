"""The pipeline against its stages done by hand, and every corpus query against SQL."""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tributary.llm import pii, quality_classifier
from tributary.llm.registry import LLM_ORACLE, LLM_QUERIES

from .conftest import SMALL
from .test_text_operators import check_pieces, dedup_by_hand, jaccard_by_hand, words_of


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    shared = " ".join(f"shared{i}" for i in range(8))
    rows, labels = [], []
    for i in range(240):
        good = rng.random() < 0.75
        text = words_of(rng, rng.randrange(20, 90), 400)
        if i % 10 == 0:
            text += f"\n{shared}\ncard 4111 1111 1111 1111 or a@b.cc"
        if i % 17 == 0 and i:
            text = rows[-1][1] + " tail"
        rows.append((i, text if good else " ".join(w + "$$$" for w in text.split()), "en", f"src{i % 3}", len(text), "x"))
        labels.append((i, int(good), 0))
    rows += [(300, None, None, None, None, None), (301, "", "en", "src0", 0, "x")]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, sequence_id string").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_stages_equal_the_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns
    model = quality_classifier.train(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] >= quality_classifier.THRESHOLD]
    assert 150 < len(rows) < 220
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, corpus).collect(), docs.schema)
        assert docs.columns == columns
        texts[name] = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert texts["quality_classifier"] == sorted(rows, key=repr)
    deduped = [(d, t) for d, _, _, t in dedup_by_hand(rows)]
    assert texts["line_dedup"] == sorted(deduped, key=repr)
    named = {d: c for d, _, c in jaccard_by_hand(deduped, 5, 80)}
    single = [(d, t) for d, t in deduped if named[d] == d]
    assert len(single) < len(deduped)
    assert texts["ngram_join"] == sorted(single, key=repr)
    single_docs = spark.createDataFrame(single, "doc_id long, text string")
    finder = pii.train(single_docs)
    redacted = sorted([(d, pii.redact_text(t, pii.find(t, finder)[1])) for d, t in single], key=repr)
    assert texts["pii"] == redacted and any("[CARD]" in t for _, t in redacted)
    packed = corpus_pipeline.run(spark, corpus).collect()
    check_pieces(packed, redacted, 4096)


def test_pipeline_of_an_empty_table(spark, corpus, tmp_path):
    spark.read.parquet(f"{corpus}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{corpus}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_query_is_registered():
    names = set(entry_points.queries())
    assert set(LLM_QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_join", "pii", "packing"]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_against_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "events", "labels", "embeddings", "conversations"):
        connection.execute(f"create view {table} as from '{SMALL}/{table}.parquet'")
    result = connection.execute(LLM_ORACLE[name])
    columns = [column[0] for column in result.description]
    df = LLM_QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(map(repr, result.fetchall()))


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLE)))
def test_query_covers_its_table(spark, name):
    table = {"op3": "embeddings", "op11": "conversations"}.get(name.split("_")[0], "documents")
    df = LLM_QUERIES[name](spark, SMALL)
    key = df.columns[0]
    got = df.select(key).distinct().count()
    assert got == spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).distinct().count()


def test_batches_for_python_are_bounded(spark):
    """4,000 texts of 3 kB do not go to Python at once, unless the session says so."""
    docs = spark.range(0, 4_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 600).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    before = spark.conf.get(corpus_pipeline.BATCH, None)
    try:
        for chosen, least, most in ((None, 1 << 20, 5 << 20), ("32m", 10 << 20, 34 << 20)):
            spark.conf.unset(corpus_pipeline.BATCH) if chosen is None else spark.conf.set(corpus_pipeline.BATCH, chosen)
            measure = corpus_pipeline.bounded(lambda _, rows, folder: rows.mapInArrow(sizes, "size long"))
            assert least < max(row.size for row in measure(spark, docs, SMALL).collect()) < most
        assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
    finally:
        spark.conf.unset(corpus_pipeline.BATCH) if before is None else spark.conf.set(corpus_pipeline.BATCH, before)

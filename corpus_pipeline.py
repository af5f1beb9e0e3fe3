"""From documents to packed training sequences: five stages, each one corpus operator.

Every stage takes what its predecessor kept, as Parquet, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.llm import line_dedup, ngram_join, packing, pii
from tributary.llm import quality_classifier as quality
from tributary.llm.names import quoted, unused
from tributary.sources.scratch import stored

#: Bytes of text that go to Python at once. An executor holds a batch several times over
#: for each of its tasks, outside its heap and in the workers, which keep what they took
#: once through all stages.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bounded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with batches of BATCH_BYTES where the session has not chosen a bound.

    The setting stays, since a stage is only run where its result is written.
    """

    @functools.wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_bounded


@bounded
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it is fitted on the labels beside the documents."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    [score] = unused(docs, "score")
    scored = quality.score(docs, model, out=score)
    return scored.where(F.col(score) >= quality.THRESHOLD).select(*map(quoted, docs.columns))


@bounded
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a later document holds as well."""
    # Columns that the operator replaces are carried under other names.
    own = [name for name in docs.columns if name.lower() in ("n_lines", "n_dropped")]
    names = dict(zip(own, unused(docs, *(f"own_{name}" for name in own))))
    found = line_dedup.dedup_lines(docs.withColumnsRenamed(names)).drop("n_lines", "n_dropped")
    return found.withColumnsRenamed({name: before for before, name in names.items()}).select(*map(quoted, docs.columns))


@bounded
def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: five-word shingles, similarity 0.8."""
    return ngram_join.keep_one(docs, n=5, percent=80)


@bounded
def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs, pii.train(docs))


@bounded
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The classifier, the boosted trees and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is stored in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

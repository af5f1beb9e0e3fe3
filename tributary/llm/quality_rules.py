"""Quality rules judged per host: failure rates of a host, shrunk by an empirical beta prior.

A document's own rule failures are counted first. Each host's failure rate per rule is
then drawn towards the rate that is usual among hosts, the more the fewer documents the
host has, and hosts whose shrunk rate is high are rejected with all their documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.llm.words import IS_SPACE, Words, ngrams, text_slices
from tributary.sources.scratch import stored

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: A host is rejected when a rule's shrunk failure rate is above this.
MAX_RATE = 0.5
#: The prior weighs as much as so many documents at least, so one page condemns no host.
MIN_WEIGHT = 10.0
#: Rules by name; each is a condition on the counts of a document.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 5 * n_words",
    "dup_lines": "3 * n_dup_lines > n_lines",
    "odd_words": "word_chars > 15 * n_words OR word_chars < 2 * n_words",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SCHEMA = "doc_id long, host string, " + ", ".join(f"{name} long" for name in COUNTS)


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each text (id, host, text columns in this order)."""
    for batch in batches:
        ids, hosts, texts = batch.columns
        rows = []
        for _, _, offsets, data in text_slices(texts):
            words = Words(offsets, data)
            hashes = words.hashes()
            space, symbol = IS_SPACE[data], SYMBOLS[data]
            begins = (data & 0xC0) != 0x80  # the first byte of a code point
            inside = begins & ~space
            for i in range(len(offsets) - 1):
                a, b = offsets[i], offsets[i + 1]
                own = hashes[words.bounds[i] : words.bounds[i + 1]]
                dup, lines = _lines(data[a:b].tobytes())
                rows.append(
                    (len(own), np.count_nonzero(inside[a:b]), np.count_nonzero(symbol[a:b]), dup, _repeated(own), lines)
                )
        columns = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
        arrays = [ids, hosts, *(pa.array(np.ascontiguousarray(column)) for column in columns)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "host", *COUNTS])


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    if b"\n" not in text:
        return 0, int(bool(text.strip(b" \t\n\r\x0b\x0c")))
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines)), len(lines)


def _repeated(words: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    _, number, count = np.unique(ngrams(words, 3), return_inverse=True, return_counts=True)
    again = count[number] > 1
    covered = np.zeros(len(words), bool)
    for place in range(3):
        covered[place : place + len(again)] |= again
    return int(np.count_nonzero(covered))


def host_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_RATE
) -> DataFrame:
    """Counts, base verdict and final verdict of each document.

    Null text has no words. Documents without a host are judged by their own rules alone.
    Every row gives a row, repeated ones too, and counts for its host. Columns other than
    the three named are not read, so they cannot clash. An empty table gives no rows.

    Hosts are aggregated map-side before they shuffle, so a host with a third of the rows
    is one partial row per task. What joins back is stored, with one row per host; Spark
    broadcasts it below its own size limit and can split a hot host otherwise.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text")
    )
    counted = stored(narrow.mapInArrow(measure, SCHEMA), "rules")
    verdicts = host_verdicts(counted, max_rate)
    base = F.expr(f"({RULES['short']}) OR ({RULES['repeats']})")
    return (
        counted.join(verdicts.select("host", "host_ok"), "host", "left")
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce("host_ok", F.lit(True)))
    )


def host_verdicts(counted: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """A row per host: documents, shrunk failure rate per rule, verdict.

    The prior of a rule is the beta distribution with the mean and variance of the hosts'
    raw rates (method of moments). With one host, no spread, or hosts that are all good or
    all bad, hosts are drawn to the common mean with the weight of MIN_WEIGHT documents.
    """
    failures = [F.sum(F.when(F.expr(rule), 1).otherwise(0)).alias(f"f_{name}") for name, rule in RULES.items()]
    hosts = counted.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"), *failures)
    hosts = stored(hosts, "hosts")
    moments = []
    for name in RULES:
        rate = F.col(f"f_{name}") / F.col("n")
        moments += [F.avg(rate).alias(f"m_{name}"), F.var_samp(rate).alias(f"v_{name}")]
    prior = hosts.agg(*moments).first()  # one row: two numbers per rule
    for name in RULES:
        alpha, beta = beta_prior(prior[f"m_{name}"], prior[f"v_{name}"])
        hosts = hosts.withColumn(f"rate_{name}", (F.col(f"f_{name}") + alpha) / (F.col("n") + alpha + beta))
    worst: Column = F.greatest(*[F.col(f"rate_{name}") for name in RULES])
    return hosts.withColumn("host_ok", worst <= max_rate)


def beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """Parameters of the beta distribution with these moments."""
    mean = mean or 0.0
    weight = mean * (1 - mean) / variance - 1 if variance else MIN_WEIGHT
    weight = max(weight, MIN_WEIGHT)
    return mean * weight, (1 - mean) * weight


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the host-level rules, with ``source`` as the host."""
    judged = host_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    flags = ",\n         ".join(f"avg(CASE WHEN {rule} THEN 1.0 ELSE 0.0 END) AS r_{name}, sum(CASE WHEN {rule} THEN 1 ELSE 0 END) AS f_{name}" for name, rule in RULES.items())
    moments = ", ".join(f"coalesce(avg(r_{n}), 0) AS m_{n}, var_samp(r_{n}) AS v_{n}" for n in RULES)
    weights = ", ".join(f"greatest(coalesce(m_{n} * (1 - m_{n}) / nullif(v_{n}, 0) - 1, {MIN_WEIGHT}), {MIN_WEIGHT}) AS w_{n}" for n in RULES)
    worst = ", ".join(f"(f_{n} + m_{n} * w_{n}) / (n + w_{n})" for n in RULES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT rid, i, words[i:i+2] AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), counted AS (
  SELECT doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN covered USING (rid)
), hosts AS (
  SELECT host, count(*) AS n, {flags}
  FROM counted WHERE host IS NOT NULL GROUP BY host
), prior AS (SELECT {moments} FROM hosts),
weights AS (SELECT *, {weights} FROM prior),
verdicts AS (SELECT host, greatest({worst}) <= {MAX_RATE} AS host_ok FROM hosts, weights),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(host_ok, true) AS kept
FROM based LEFT JOIN verdicts USING (host)
"""


ORACLE_SQL = _oracle()

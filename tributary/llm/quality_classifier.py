"""Text quality from positive and unlabelled texts: non-negative risk with a class prior.

Trusted texts are the positives; unlabelled web text is a mixture of good and bad in
proportions given by the class prior. A small network is fitted to the non-negative
unbiased risk estimate

    prior * R(positives, good) + max(0, R(unlabelled, bad) - prior * R(positives, bad))

where no text marked bad is ever used as a negative example.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tributary.llm.sampling import hashed_sample
from tributary.llm.words import IS_SPACE, Words, ngrams, text_slices

#: Bounds of the training sample: texts of each kind, those with the smallest id hashes.
MAX_POSITIVE = 8_000
MAX_UNLABELLED = 12_000
THRESHOLD = 0.3
#: The bound of the class prior's estimate holds but for this chance.
CONFIDENCE = 0.1
HELD_OUT = 5
HIDDEN, EPOCHS, BATCH, RATE = 24, 40, 512, 0.01

FEATURES = (
    "words", "word_length", "word_spread", "distinct_words", "distinct_pairs", "same_next", "longest_run", "lines",
    "distinct_lines", "upper", "digits", "marks", "symbols", "exclaims", "pipes", "brackets", "non_ascii", "ends",
    "long_words", "short_words", "late_symbols", "late_upper", "late_pairs",
)


def _class(text: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(text)] = True
    return table


UPPER = _class(bytes(range(65, 91)))
LETTER = _class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
DIGIT = _class(b"0123456789")
SYMBOL = _class(b"#*$%&@^~_=+<>")
BRACKET = _class(b"{}[]()\\/")
END = _class(b".,;:?")
CLASSES = {"upper": UPPER, "digits": DIGIT, "symbols": SYMBOL, "brackets": BRACKET, "ends": END}


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES per text; an empty text is a row of zeros.

    Shares, not lengths, so that long and short texts compare; the ``late`` ones describe
    the second half, where a text may turn bad.
    """
    rows = np.zeros((len(texts), len(FEATURES)), np.float32)
    for first, _, offsets, data in text_slices(texts):
        words = Words(offsets, data)
        hashes = words.hashes(lower=True)
        lengths = (words.ends - words.starts).astype(np.float64)
        for i in range(len(offsets) - 1):
            w0, w1 = words.bounds[i], words.bounds[i + 1]
            if w1 > w0:
                rows[first + i] = _row(data[offsets[i] : offsets[i + 1]], hashes[w0:w1], lengths[w0:w1])
    return rows


def _row(data: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> list[float]:
    n = len(words)
    counts = np.bincount(data, minlength=256)
    chars = max(1, int(counts[~IS_SPACE].sum()))
    share = {name: counts[table].sum() / chars for name, table in CLASSES.items()}
    letters = max(1, int(counts[LETTER].sum()))
    pairs = ngrams(words, 2)
    same = words[1:] == words[:-1]
    changes = np.flatnonzero(np.concatenate(([True], ~same, [True])))
    lines = data.tobytes().split(b"\n")
    filled = [line for line in lines if line.strip()]
    late = data[len(data) // 2 :]
    late_counts = np.bincount(late, minlength=256)
    late_chars = max(1, int(late_counts[~IS_SPACE].sum()))
    late_pairs = pairs[len(pairs) // 2 :]
    return [
        np.log1p(n), lengths.mean(), lengths.std(), len(np.unique(words)) / n, len(np.unique(pairs)) / len(pairs),
        same.mean() if n > 1 else 0.0, np.log1p(np.diff(changes).max()), np.log1p(len(lines)),
        len(set(filled)) / max(1, len(filled)), counts[UPPER].sum() / letters, share["digits"], 1 - letters / chars,
        share["symbols"], counts[33] / chars, counts[124] / chars, share["brackets"], counts[128:].sum() / chars, share["ends"],
        (lengths > 18).mean(), (lengths < 3).mean(), late_counts[SYMBOL].sum() / late_chars,
        late_counts[UPPER].sum() / max(1, late_counts[LETTER].sum()), len(np.unique(late_pairs)) / max(1, len(late_pairs)),
    ]


@dataclass(frozen=True)
class Model:
    """Scaling and weights of the network, and the class prior it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The estimated probability of good text."""
        hidden, out = _forward((rows - self.mean) / self.scale, self.weights)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _forward(x: np.ndarray, weights: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = weights
    hidden = np.tanh(x @ w1 + b1)
    return hidden, hidden @ w2 + b2[0]


def risk(xp: np.ndarray, xu: np.ndarray, weights: list[np.ndarray], prior: float) -> tuple[float, list[np.ndarray]]:
    """The non-negative risk of a batch of positives and unlabelled rows, and its descent.

    Where the estimated risk of the bad class turns negative, the descent is that of minus
    this risk, so that the network cannot fit the positives by calling everything else bad.
    """
    x = np.concatenate([xp, xu])
    hidden, out = _forward(x, weights)
    good = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
    n = len(xp)
    bad_loss = np.logaddexp(0, out)
    bad_risk = bad_loss[n:].mean() - prior * bad_loss[:n].mean()
    slope = np.zeros(len(x))
    if bad_risk >= 0:
        slope[:n] = prior * (good[:n] - 1) / n - prior * good[:n] / n
        slope[n:] = good[n:] / len(xu)
    else:
        slope[:n] = prior * good[:n] / n
        slope[n:] = -good[n:] / len(xu)
    back = np.outer(slope, weights[2]) * (1 - hidden**2)
    total = prior * np.logaddexp(0, -out[:n]).mean() + max(0.0, bad_risk)
    return float(total), [x.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()])]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0) -> Model:
    """Minimise the non-negative risk by Adam over mini-batches of both kinds.

    Without positives or unlabelled rows every text scores the prior.
    """
    width = len(FEATURES)
    if not len(positive) or not len(unlabelled):
        odds = np.log(prior / (1 - prior)) if 0 < prior < 1 else 30.0 * (prior > 0) - 15.0
        flat = (np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.array([odds]))
        return Model(np.zeros(width), np.ones(width), flat, prior)
    return _descend(positive, unlabelled, prior, seed)


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0) -> Model:
    width = positive.shape[1]
    every = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = every.mean(0), every.std(0) + 1e-6
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    rng = np.random.default_rng(seed)
    weights = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    batches = max(1, len(u) // BATCH)
    for epoch in range(EPOCHS):
        order_p, order_u = rng.permutation(len(p)), rng.permutation(len(u))
        for b in range(batches):
            xp, xu = p[order_p[b::batches]], u[order_u[b::batches]]
            if not len(xp):
                xp = p
            _, grads = risk(xp, xu, weights, prior)
            grads = [grads[0] + 1e-4 * weights[0], grads[1], grads[2] + 1e-4 * weights[2], grads[3]]
            step += 1
            for k, grad in enumerate(grads):
                m, v = moments[k]
                m = 0.9 * m + 0.1 * grad
                v = 0.999 * v + 0.001 * grad**2
                moments[k] = (m, v)
                weights[k] = weights[k] - RATE / (1 + epoch / 10) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, tuple(weights), prior)


def mixture_share(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good texts among the unlabelled, without a single bad example.

    A network ranks texts by how like the positives they are. Above any cut on its score the
    unlabelled hold at least their good ones, so the share is at most their part above the
    cut divided by the positives' part; near the top, where bad texts are rare, it is
    equal to it. The cut is the one with the least upper confidence bound of this quotient.
    Each half of the rows is ranked by a network fitted on the other half.
    """
    rng = np.random.default_rng(0)
    halves = [rng.permutation(len(rows)) % 2 for rows in (positive, unlabelled)]
    shares = []
    for half in (0, 1):
        kept = [rows[side != half] for rows, side in zip((positive, unlabelled), halves)]
        held = [rows[side == half] for rows, side in zip((positive, unlabelled), halves)]
        if not all(map(len, kept + held)):
            return 0.5
        ranker = _descend(*kept, 0.5)
        zp, zu = (np.sort(ranker.score(rows.astype(np.float64))) for rows in held)
        cuts = np.unique(zp)
        above_p = 1 - np.searchsorted(zp, cuts, "left") / len(zp)
        above_u = 1 - np.searchsorted(zu, cuts, "left") / len(zu)
        doubt = sum(np.sqrt(np.log(4 / CONFIDENCE) / (2 * len(z))) for z in (zp, zu))
        best = np.argmin((above_u + doubt) / above_p)
        shares.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(shares), 0.01, 1.0))


def fold(id_col: str) -> Column:
    """The fold of a row, from its id alone; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT, F.lit(0))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Fit a model outside the held-out fold.

    The positives are up to ``max_positive`` documents labelled 1, the unlabelled texts up
    to ``max_unlabelled`` documents of any kind, each chosen by the hash of their id; of rows
    that repeat an id, the one with the smallest features stands for it. The class prior is
    the share of 1 among all labels outside the held-out fold; where these mark nothing but
    positives, it is estimated from the two samples by ``mixture_share``. The two id lists
    have that documented bound; they are what is broadcast, and their features are what
    comes to the driver.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(fold("id") != 0).where("label is not null")
    prior = known.agg(F.avg("label")).first()[0]
    prior = 0.5 if prior is None else float(prior)

    def smallest(rows: DataFrame, limit: int) -> DataFrame:
        picked = hashed_sample(rows.select("id"), limit, "id")
        return spark.createDataFrame([(row.id,) for row in picked], rows.select("id").schema)

    ids = docs.select(F.col(id_col).alias("id")).where(fold("id") != 0)
    positive = smallest(known.where("label = 1"), max_positive)
    unlabelled = smallest(ids, max_unlabelled)
    wanted = positive.select("id", F.lit(True).alias("p")).join(unlabelled.select("id", F.lit(True).alias("u")), "id", "full")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(wanted), "id").select("id", "p", "u", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features(batch["text"])
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["p"], batch["u"], flat], names=["id", "p", "u", "x"])

    kind = dict(texts.dtypes)["id"]
    measured = sample.mapInArrow(measure, f"id {kind}, p boolean, u boolean, x array<float>")
    # One row per id, combined map-side: an id that many rows repeat counts once.
    rows = measured.groupBy("id", "p", "u").agg(F.min("x").alias("x")).toPandas()
    rows = rows.assign(bytes_=[np.asarray(x, np.float32).tobytes() for x in rows["x"]]).sort_values(["id", "bytes_"])
    matrix = np.array(list(rows["x"]), np.float32).reshape(-1, len(FEATURES))
    is_p, is_u = (rows["p"] == True).to_numpy(bool), (rows["u"] == True).to_numpy(bool)  # noqa: E712
    if prior == 1.0:
        prior = mixture_share(matrix[is_p], matrix[is_u])
    return fit(matrix[is_p], matrix[is_u], prior)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of good text, in one pass and without a shuffle.

    Null counts as empty; an empty text has its own score like any other. Every row stays.
    A column named like ``out`` is replaced.
    """
    columns = [name for name in docs.columns if name != out]
    rows = docs.select(*columns)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(features(batch[text_col]).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*columns, out])

    return rows.mapInArrow(judge, StructType([*rows.schema.fields, StructField(out, DoubleType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model that never saw the held-out fold's labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model).drop("text")
    return scored.select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

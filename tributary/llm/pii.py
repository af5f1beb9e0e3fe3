"""Personal data: candidate spans from loose generators, chosen by gradient-boosted trees.

Strict patterns give the base spans, which always count. Looser generators propose more:
spelled-out addresses, numbers with other separators or without a plus, and runs of digit
groups inside longer numbers, which a strict match swallows whole. Proposals may overlap.
Boosted trees judge each from its format and its surroundings. They are trained on strict
matches and on what the same generators propose around those that pass their checks
(digit sums, ranges, lengths), where these stand and where they are planted beside another
number or spelled out. A threshold per kind, calibrated on held-back proposals, selects
what is added, and of overlapping proposals the likeliest stays. All examples of all texts
train and calibrate: the trees grow from sums that Spark's tasks take over them.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tributary.sources.scratch import discard, stored

KINDS = ("email", "ip", "card", "phone")
#: Share of held-back candidates above the threshold that must be real.
PRECISION = 0.99
TREES, DEPTH, LEARNING_RATE, BINS, MIN_LEAF = 40, 3, 0.2, 32, 20
#: Probabilities are rounded to one part in so many, so that their sums over up to 2**33
#: examples are exact and do not depend on how the examples are dealt to tasks.
PARTS = 1 << 20
#: Code points on either side that describe the surroundings.
CONTEXT = 24
#: Proposals of a text that are described at once.
JUDGED = 4_096

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts at the first digit of a run, for a later start in the run ends alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Loose forms. Each is bounded, so that a search of a text takes time in its length.
_DOT = r"(?:\.| ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| dot )"
_LOOSE = {
    "email": re.compile(
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}(?: ?[(\[{] ?(?:at|@) ?[)\]}] ?| @ ?|@ | at )[a-z0-9-]{1,63}"
        rf"(?:{_DOT}[a-z0-9-]{{1,63}}){{1,8}}"
    ),
    "ip": re.compile(rf"(?i)(?<![0-9.])[0-9]{{1,3}}(?:(?: ?\. ?|{_DOT})[0-9]{{1,3}}){{3}}(?![0-9]|\.[0-9])"),
    "phone": re.compile(
        r"(?i)(?<![0-9+])(?:00[0-9]{1,3}[ .-]?|plus ?[0-9]{1,3}[ .-]?|1[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
    ),
}
_NEEDS = {"email": re.compile(r"(?i)@|\bat\b"), "digits": re.compile("[0-9]")}
_GROUP = re.compile("[0-9]+")
# Digit groups that may hold a card or an address between other numbers.
_NUMBERS = re.compile("[0-9]++(?:[ ./_-]{1,3}[0-9]++)*+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){4,}+")
# Spellings under which known spans are planted for the training.
_AT_DOT = ((" at ", " dot "), (" AT ", " DOT "), (" (at) ", "."), ("[at]", "[dot]"), (" @ ", "."), (" At ", " Dot "), ("(AT)", "(DOT)"))
_DOTS = ("[.]", " dot ", "(.)", " DOT ", "[dot]", " . ")
_CUES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "addr", "server"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("tel", "phone", "call", "fax", "mobil"),
}
FEATURES = (
    "email", "ip", "card", "phone", "loose", "length", "digits", "letters", "separators", "kinds_of_separator", "groups",
    "longest_group", "shortest_group", "luhn", "small_parts", "distinct_digits", "starts_zero", "left_space", "right_space",
    "left_digit", "right_digit", "left_sign", "right_sign", "cue", "digits_near", "line_start", "first_group", "last_group",
    "spelled", "number_before", "number_after", "letter_beside",
)

LOOSE = FEATURES.index("loose")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in time linear in the text.

    A match has one @, before which it reaches back over the whole run of local
    characters, as far as the match before allows.
    """
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def strict_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passes its check) of the strict patterns."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end, True
    if not _NEEDS["digits"].search(text):
        return
    for found in _IP.finditer(text):
        parts = (part.lstrip("0") for part in found.group().split("."))
        yield "ip", *found.span(), all(len(part) < 4 and int(part or 0) < 256 for part in parts)
    for found in _CARD.finditer(text):
        digits = re.sub("[ -]", "", found.group())
        yield "card", *found.span(), 16 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for found in _PHONE.finditer(text):
            yield "phone", *found.span(), 8 <= sum(c.isdigit() for c in found.group()) <= 15


def loose_matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Further proposals; they may overlap each other and the strict ones.

    Besides the loose forms: consecutive digit groups of 16 to 19 digits, four dotted parts
    of a longer row, and what a strict phone match holds up to the end of any digit group.
    A group begins at most four proposals of 16 digits or more, so that their number is
    linear in the text.
    """
    if _NEEDS["email"].search(text):
        for found in _LOOSE["email"].finditer(text):
            yield "email", *found.span()
    if not _NEEDS["digits"].search(text):
        return
    for kind in ("ip", "phone"):
        for found in _LOOSE[kind].finditer(text):
            yield kind, *found.span()
    for found in _DOTTED.finditer(text):
        groups = [group.span() for group in _GROUP.finditer(text, *found.span())]
        for four in zip(groups, groups[1:], groups[2:], groups[3:]):
            if all(end - start < 4 and int(text[start:end]) < 256 for start, end in four):
                yield "ip", four[0][0], four[3][1]
    for found in _NUMBERS.finditer(text):
        if found.end() - found.start() < 16:
            continue
        groups = [group.span() for group in _GROUP.finditer(text, *found.span())]
        for first in range(len(groups)):
            digits = 0
            for last in range(first, min(first + 19, len(groups))):
                digits += groups[last][1] - groups[last][0]
                if digits > 19:
                    break
                if digits >= 16:
                    yield "card", groups[first][0], groups[last][1]
    if "+" in text:
        for found in _PHONE.finditer(text):
            digits = 0
            for group in _GROUP.finditer(text, *found.span()):
                digits += group.end() - group.start()
                if digits > 15:
                    break
                if digits >= 8:
                    yield "phone", found.start(), group.end()


def _fits(text: str, kind: str, start: int, end: int) -> bool:
    """Whether the digits of a proposal pass the check of its kind."""
    groups = _GROUP.findall(text, start, end)
    if kind == "card":
        return luhn("".join(groups))
    return kind != "ip" or all(len(group) < 4 and int(group) < 256 for group in groups)


def _planted(text: str, kind: str, start: int, end: int) -> Iterator[tuple[str, list[tuple[str, int, int]], int, int]]:
    """Texts with a known span beside another number or spelled out, in its surroundings.

    With each come the spans that are real and the place outside of which nothing is known.
    What is planted follows from the span alone.
    """
    span, left, right = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    seed = hashlib.blake2b(span.encode()).digest()

    def put(*parts: tuple[str | None, str]) -> tuple[str, list[tuple[str, int, int]], int, int]:
        at, real = len(left), []
        for part, own in parts:
            if part:
                real.append((part, at, at + len(own)))
            at += len(own)
        return left + "".join(own for _, own in parts) + right, real, len(left), at

    if kind == "email":
        local, _, domain = span.partition("@")
        at, dot = _AT_DOT[seed[0] % len(_AT_DOT)]
        yield put((kind, local + at + domain.replace(".", dot)))
        yield put((None, (re.findall(r"[A-Za-z]+", left) or ["look"])[-1] + " at " + domain))
        return
    if kind == "ip":
        yield put((kind, span.replace(".", _DOTS[seed[0] % len(_DOTS)])))
        parts = span.split(".")
        parts[seed[1] % 4] = str(256 + seed[2])
        yield put((None, _DOTS[seed[0] % len(_DOTS)].join(parts)))
    if kind == "card":
        digits, mark = re.sub("[ -]", "", span), "./_"[seed[0] % 3]
        yield put((kind, mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))))
    if kind == "phone":
        yield put((kind, ("", "00", "plus ")[seed[0] % 3] + span[1:]))
    number = str(4 + seed[3] % 2) + "".join(str(byte % 10) for byte in seed[4:18])
    number += next(digit for digit in "0123456789" if luhn(number + digit))
    if seed[18] % 2:
        number = " ".join(number[i : i + 4] for i in range(0, 16, 4))
    address = ".".join(map(str, seed[20:24]))
    space = " -"[seed[24] % 4 == 0]
    for other, own in (("card", number), ("ip", address)):
        yield put((kind, span), (None, space), (other, own))
        yield put((other, own), (None, space), (kind, span))
    if kind == "phone":
        yield put((kind, span), (None, "."), ("ip", address))


def examples(text: str) -> Iterator[tuple[str, str, int, int, bool, bool]]:
    """(text, kind, start, end, loose, real) of candidates whose truth is known.

    Strict matches are real if they pass. A proposal is real if it is a passing match or
    what was planted, and is not if it fails its check or cuts across one of those; of the
    others nothing is known, and they are left out.
    """
    strict = list(strict_matches(text))
    for kind, start, end, passes in strict:
        yield text, kind, start, end, False, passes
    base = {(kind, start, end) for kind, start, end, passes in strict if passes}
    taken = _Places((start, end) for _, start, end in base)
    for proposal in loose_matches(text):
        if proposal in base or taken.touch(*proposal[1:]) or not _fits(text, *proposal):
            yield text, *proposal, True, proposal in base
    for span in sorted(base):
        for made, real, begin, stop in _planted(text, *span):
            for proposal in loose_matches(made):
                if proposal[1] < stop and begin < proposal[2]:
                    yield made, *proposal, True, proposal in real


class _Places:
    """Places of a text, united where they overlap."""

    def __init__(self, places: Iterable[tuple[int, int]] = ()):
        self.held: list[tuple[int, int]] = []
        for start, end in sorted(places):
            if self.held and start < self.held[-1][1]:
                self.held[-1] = (self.held[-1][0], max(end, self.held[-1][1]))
            else:
                self.held.append((start, end))

    def touch(self, start: int, end: int) -> bool:
        before = bisect_left(self.held, (end,)) - 1
        return before >= 0 and self.held[before][1] > start

    def add(self, start: int, end: int) -> None:
        """Add a place that touches none."""
        insort(self.held, (start, end))


def describe(text: str, kind: str, start: int, end: int, loose: bool) -> list[float]:
    """The FEATURES of a candidate."""
    span = text[start:end]
    left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    separators = [c for c in span if not c.isalnum()]
    near = left[-1:] or "\n", right[:1] or "\n"
    return [
        *(float(kind == k) for k in KINDS), float(loose), min(len(span), 200), min(len(digits), 40), sum(map(str.isalpha, span[:200])),
        len(separators), len(set(separators)), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(0 < len(digits) < 40 and luhn(digits)), sum(len(g) < 4 and int(g) < 256 for g in groups), len(set(digits)),
        float(digits[:1] == "0"), float(near[0].isspace()), float(near[1].isspace() or near[1] in ".,;:!?"), float(near[0].isdigit()),
        float(near[1].isdigit()), float(near[0] in "=/_-+.@"), float(near[1] in "=/_-+@"),
        float(any(cue in left.lower() for cue in _CUES[kind])), sum(map(str.isdigit, left + right)), float(near[0] == "\n"),
        len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0, len(re.findall(r"(?i)\b(?:at|dot|plus)\b|[(\[{]", span)),
        float(left.rstrip(" ./_()-")[-1:].isdigit()), float(right.lstrip(" ./_()-")[:1].isdigit()), float(near[0].isalpha() or near[1].isalpha()),
    ]


@dataclass(frozen=True)
class Model:
    """Boosted trees as (feature, cut, leaf values) of full binary trees, and thresholds."""

    base: float
    trees: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]
    thresholds: dict[str, float]

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for feature, cut, leaves in self.trees:
            total += leaves[_leaf(rows, feature, cut)]
        return 1 / (1 + np.exp(-total))


def _leaf(rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    node = np.zeros(len(rows), np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > cut[node])
    return node - (2**depth - 1)


#: Inner parts of the quantiles at which a feature may be cut.
QUANTILES = [k / BINS for k in range(1, BINS)]


def binned(rows: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """For each value, how many cuts of its feature lie below it."""
    bins = np.zeros(rows.shape, np.uint8)
    for f, values in enumerate(cuts):
        bins[:, f] = np.searchsorted(values, rows[:, f], "left")
    return bins


def split_sums(bins: np.ndarray, total: np.ndarray, real: np.ndarray, model: Model, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """Sums of gradient, weight and number, by node of the level, feature and bin.

    A row stands for ``total`` examples, ``real`` of which are real. ``model`` is what has
    grown so far and (``feature``, ``cut``) the tree at work, with cuts as numbers of bins.
    """
    p = model.score(bins)
    gradient = real - total * (np.rint(p * PARTS) / PARTS)
    weight = total * (np.rint(p * (1 - p) * PARTS) / PARTS)
    width = bins.shape[1]
    cells = ((_leaf(bins, feature, cut, level)[:, None] * width + np.arange(width)) * BINS + bins).ravel()
    sums = [np.bincount(cells, np.repeat(own, width), 2**level * width * BINS) for own in (gradient, weight, total)]
    return np.stack(sums, 1).reshape(2**level, width, BINS, 3)


def grow(cuts: list[np.ndarray], total: int, real: int, sums: Callable[..., np.ndarray]) -> tuple[Model, tuple]:
    """Trees for the log loss, with Newton steps in the leaves, from the ``split_sums`` of all examples.

    ``sums`` gets the last four arguments of ``split_sums``. Returned are the model over
    bins, and its trees with the values of ``cuts``.
    """
    rate = np.clip(real / total if total else 0.5, 1e-3, 1 - 1e-3)
    model = Model(float(np.log(rate / (1 - rate))), (), {})
    for _ in range(TREES if 0 < real < total else 0):
        # No bin lies above the last.
        feature, cut, leaves = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS), np.zeros(2**DEPTH)
        for level in range(DEPTH):
            for node, own in enumerate(sums(model, feature, cut, level)):
                below = own.cumsum(1)
                every = below[0, -1]
                (g, h, n), (gs, hs, ns) = np.moveaxis(below, -1, 0), every
                gain = g**2 / (h + 1) + (gs - g) ** 2 / (hs - h + 1) - gs**2 / (hs + 1)
                gain[(n < MIN_LEAF) | (ns - n < MIN_LEAF)] = 0
                f, k = np.unravel_index(gain.argmax(), gain.shape)
                left = every
                if gain[f, k] > 1e-9:
                    feature[2**level - 1 + node], cut[2**level - 1 + node], left = f, k, below[f, k]
                if level == DEPTH - 1:
                    leaves[2 * node : 2 * node + 2] = [LEARNING_RATE * g / (h + 1) for g, h, _ in (left, every - left)]
        model = Model(model.base, (*model.trees, (feature, cut, leaves)), {})
    value = lambda f, k: cuts[f][k] if k < BINS else np.inf
    return model, tuple((feature, np.array([*map(value, feature, cut)]), leaves) for feature, cut, leaves in model.trees)


def boost(rows: np.ndarray, real: np.ndarray) -> tuple[float, tuple]:
    """What ``grow`` returns for examples in memory, with cuts at quantiles."""
    cuts = [np.unique(np.quantile(rows[:, f], QUANTILES)) if len(rows) else np.zeros(1) for f in range(rows.shape[1])]
    bins, ones = binned(rows, cuts), np.ones(len(rows))
    model, trees = grow(cuts, len(rows), real.sum(), lambda *grown: split_sums(bins, ones, real, *grown))
    return model.base, trees


def calibrate(scores: np.ndarray, real: np.ndarray, precision: float = PRECISION) -> float:
    """The lowest threshold at and above which ``precision`` of the candidates are real.

    Above 1, so that nothing is chosen, if there is none.
    """
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(real[order]) / np.arange(1, len(order) + 1)
    last_of_tie = np.append(np.diff(scores[order]) != 0, True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((right >= precision) & last_of_tie)
    return float(scores[order][good[-1]]) if len(good) else 2.0


def thresholds_of(scored: DataFrame, precision: float = PRECISION) -> dict[str, float]:
    """``calibrate`` by kind, for rows of kind (its number), score, total and real.

    Scores are cut into slots by their log odds. What lies above a slot is summed over at
    most 4,000 slots a kind, and what lies above a score over its slot.
    """
    ties = scored.groupBy("kind", "score").agg(F.sum("total").alias("total"), F.sum("real").alias("real"))
    within = F.least(F.greatest("score", F.lit(1e-12)), F.lit(1 - 1e-12))
    ties = stored(ties.withColumn("slot", F.floor(64 * F.log(within / (1 - within)))), "scores")
    higher = Window.partitionBy("kind").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    slots = ties.groupBy("kind", "slot").agg(F.sum("total").alias("n"), F.sum("real").alias("k"))
    slots = slots.select("kind", "slot", *[F.coalesce(F.sum(name).over(higher), F.lit(0)).alias(name) for name in "nk"])
    upto = Window.partitionBy("kind", "slot").orderBy(F.desc("score"))
    ranked = ties.join(F.broadcast(slots), ["kind", "slot"]).select(
        "kind", "score", (F.col("k") + F.sum("real").over(upto)).alias("k"), (F.col("n") + F.sum("total").over(upto)).alias("n")
    )
    good = ranked.where(F.col("k") / F.col("n") >= precision).groupBy("kind").agg(F.min("score").alias("score")).collect()
    discard(ties)
    return dict.fromkeys(KINDS, 2.0) | {KINDS[row.kind]: row.score for row in good}


def described(text: str) -> Iterator[tuple[str, bool, list[float]]]:
    """(mark, real, FEATURES) of the ``examples``; equal spans in equal surroundings have one mark."""
    for made, kind, start, end, loose, known in examples(text):
        around = f"{loose}:{start - max(0, start - CONTEXT)}:{made[max(0, start - CONTEXT) : end + CONTEXT][:400]}:{end - start}"
        mark = hashlib.blake2b(f"{kind}:{around}".encode(), digest_size=8).hexdigest()
        yield mark, known, describe(made, kind, start, end, loose)


def train(docs: DataFrame, text_col: str = "text", precision: float = PRECISION) -> Model:
    """Fit on the ``examples`` of all texts, each mark counting once.

    All of them are used. Four fifths fit the trees, the proposals of the rest calibrate
    them. Examples with equal bins are stored as one row with their numbers. For each level
    of a tree the tasks sum up what its splits need, in arrays of 100 kB at most, which are
    added in a tree if there are many; the driver gets these, the quantiles of the features
    and the thresholds.
    A kind without real proposals in the fifth gets no additions.
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row for text in batch["text"] for row in described(text.as_py() or "")]
            arrays = [pa.array([row[i] for row in found], kind) for i, kind in enumerate((pa.string(), pa.bool_(), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays(arrays, names=["mark", "real", "x"])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    found = texts.mapInArrow(candidates, "mark string, real boolean, x array<double>")
    # Combined map-side: a group of copies of any size is one row.
    marked = found.groupBy("mark").agg(F.min(F.struct("real", "x")).alias("row")).select("mark", "row.*")
    held = F.conv(F.substring("mark", -2, 2), 16, 10).cast("int") % 5 == 0
    known = stored(marked.select(held.alias("held"), F.col("real").cast("long").alias("real"), "x"), "examples")

    fitted = known.where(~F.col("held"))
    at = fitted.agg(*[F.percentile(F.col("x")[f], QUANTILES) for f in range(len(FEATURES))]).first()
    cuts = [np.unique(values) if values else np.zeros(1) for values in at]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            kind = np.where(batch["held"].to_numpy(zero_copy_only=False), rows[:, : len(KINDS)].argmax(1), -1)
            bins = pa.array([row.tobytes() for row in binned(rows, cuts)], pa.binary())
            used = pa.array((kind < 0) | (rows[:, LOOSE] == 1))
            placed = pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), bins, batch["real"]], names=["kind", "bins", "real"])
            yield placed.filter(used)

    placed = known.mapInArrow(place, "kind int, bins binary, real long").groupBy("kind", "bins")
    patterns = stored(placed.agg(F.count("*").alias("total"), F.sum("real").alias("real")), "patterns")
    discard(known)
    learned = patterns.where("kind < 0")
    total, real = learned.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("real"), F.lit(0))).first()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [b"".join(batch["bins"].to_pylist()), *(batch[name].to_numpy().astype(np.float64).tobytes() for name in ("total", "real"))]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary()) for part in parts], names=["bins", "total", "real"])

    # A row per batch, for the many rounds that read them.
    packs = stored(learned.select("bins", "total", "real").mapInArrow(packed, "bins binary, total binary, real binary"), "packs")
    blocks = packs.rdd.map(lambda row: (_bins(row.bins), np.frombuffer(row.total), np.frombuffer(row.real)))

    # Few arrays go to the driver as they are, which saves a shuffle a round.
    depth = 1 if blocks.getNumPartitions() <= 64 else 2

    def sums(*grown: object) -> np.ndarray:
        return blocks.map(lambda block: split_sums(*block, *grown)).treeReduce(np.add, depth)

    grown, trees = grow(cuts, total, real, sums)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(grown.score(_bins(b"".join(batch["bins"].to_pylist()))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["kind"], scores, batch["total"], batch["real"]], names=["kind", "score", "total", "real"])

    scored = patterns.where("kind >= 0").mapInArrow(judge, "kind int, score double, total long, real long")
    thresholds = thresholds_of(scored, precision)
    discard(patterns)
    discard(packs)
    return Model(grown.base, trees, thresholds)


def _bins(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, len(FEATURES))


def find(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and all spans of a text, each by kind and start."""
    base = [(kind, start, end) for kind, start, end, passes in strict_matches(text) if passes]
    taken = _Places((start, end) for _, start, end in base)
    free = sorted({p for p in loose_matches(text) if not taken.touch(p[1], p[2])})
    added: list[tuple[str, int, int]] = []
    likely: list[tuple[float, tuple[str, int, int]]] = []
    for first in range(0, len(free), JUDGED):
        part = free[first : first + JUDGED]
        scores = model.score(np.array([describe(text, *p, True) for p in part]))
        likely += [(-score, p) for score, p in zip(scores, part) if score >= model.thresholds.get(p[0], 2.0)]
    places = _Places()
    for _, (kind, start, end) in sorted(likely):
        if not places.touch(start, end):
            added.append((kind, start, end))
            places.add(start, end)
    order = {kind: number for number, kind in enumerate(KINDS)}
    key = lambda span: (order[span[0]], *span[1:])
    return sorted(base, key=key), sorted(base + added, key=key)


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


FOUND = ("base_spans", "spans")


def find_spans(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: kind:start:end, comma-joined.

    Positions count code points, ends are exclusive. Null counts as empty and has no
    spans. One pass without a shuffle; every row stays. Columns of the two names are
    replaced.
    """
    columns = [name for name in docs.columns if name not in FOUND]
    rows = docs.select(*columns)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(text.as_py() or "", model) for text in batch[text_col].cast(pa.string())]
            arrays = [pa.array([_listed(spans) for spans in column], pa.string()) for column in zip(*found)] or [pa.array([], pa.string())] * 2
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*columns, *FOUND])

    return rows.mapInArrow(search, StructType([*rows.schema.fields, *(StructField(name, StringType()) for name in FOUND)]))


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind; spans that overlap become one."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans redacted; null stays null, other columns pass as they are."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (t := text.as_py()) is None else redact_text(t, find(t, model)[1]) for text in batch[text_col]]
            arrays = [pa.array(texts, pa.string()) if name == text_col else batch[name] for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return docs.mapInArrow(rewrite, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and a digest of the base spans, all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_spans(docs, train(docs)).drop("text")
    counts = [F.regexp_count("base_spans", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")

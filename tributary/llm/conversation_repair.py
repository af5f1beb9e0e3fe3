"""Repair of conversation structure by iterative-deepening A*.

A conversation has to read ``(system? (user assistant)+)?``. Its turns may be kept, given
another role, or deleted, and empty turns inserted; the cheapest such edits are wanted, and
the first in ASCII order among equally cheap ones. A depth-first search tries the edits in
that order under a cost bound that rises to the least cost beyond it, and remembers for
each (turn, state) the bound under which it failed.

Conversations may be of any length. Turns are sorted across tasks, and a conversation that
is long, or lies on a border between tasks, is cut into segments of bounded length. Each is
searched for every state it may begin and end in, which gives a small matrix of costs. The
matrices are multiplied (least sum) up a tree, the states at all borders follow down the
tree, and each segment's edits are then those found for its two states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.sources.scratch import stored

# Costs of the edits, and the price of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns in a segment at most.
SEGMENT = 64
#: Matrices that are multiplied in one group.
FAN = 1024
#: Bytes of text in one batch of segments.
BATCH_BYTES = 4 << 20

BLANKS = "".join(map(chr, (0x20, *range(0x09, 0x0E))))
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES = range(4)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that may follow in a state, for inserted turns and changed roles.
FOLLOWS = ("user", "user", "assistant", "user")
#: Turns to insert at the end.
MISSING = (0, 2, 1, 0)
LEGAL = {"su", "ua", "au"}
INF = 1 << 60

ROWS = "rows array<struct<role:string,text:string,fault:string,copies:long>>"
PARTS = f"conv string, a long, b long, whole boolean, audits array<string>, costs array<long>, {ROWS}"
NODES = "conv string, a long, b long, costs array<long>, ranks array<long>"
BORDERS = "conv string, a long, b long, entry int, exit int"
REPORT = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Search:
    """Cheapest edits of turns (initial of the role, fault) that end in the state ``goal``.

    Without a goal the conversation ends there, and missing turns may be inserted last.
    With one, insertions come before a turn, so that a border belongs to one segment.
    """

    def __init__(self, turns: list[tuple[str, str]], goal: int | None = None):
        self.turns, self.goal = turns, goal
        # A faulty turn costs two at least, whether it is deleted or stays truncated.
        self.need = np.append(np.cumsum([DELETE * bool(fault) for _, fault in turns][::-1])[::-1], 0).tolist()
        system = [i for i, (initial, fault) in enumerate(turns) if initial == "s" and fault in ("", "truncated")]
        self.last_system = max(system, default=-1)
        self.failed: dict[tuple[int, int], int] = {}

    def least(self, i: int, state: int) -> int:
        """No way from here costs less than this."""
        known = self.failed.get((i, state))
        if known is not None:
            return known
        if self.goal is None:
            return self.need[i] + INSERT * MISSING[state] if i == len(self.turns) else self.need[i]
        if i == len(self.turns):
            return 0 if state == self.goal else INF
        if self.goal == 0 and state != 0 or self.goal == 1 and state > 1:
            return INF
        if self.goal == 1 and state == 0 and i > self.last_system:
            return INF
        return self.need[i]

    def edits(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(initial, cost, turn, state) of each edit, in ASCII order."""
        if i == len(self.turns):
            if self.goal is None and MISSING[state]:
                yield "I", INSERT, i, NEXT[state][FOLLOWS[state][0]]
            return
        initial, fault = self.turns[i]
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, NEXT[state][FOLLOWS[state][0]]
        if fault in ("", "truncated"):
            price = TRUNCATED if fault else 0
            if initial in NEXT[state]:
                yield "K", price, i + 1, NEXT[state][initial]
            yield "R", REROLE + price, i + 1, NEXT[state][FOLLOWS[state][0]]

    def walk(self, i: int, state: int, budget: int) -> list[str] | None:
        """Edits from here within the budget, last one first."""
        if i == len(self.turns) and (not MISSING[state] if self.goal is None else state == self.goal):
            return []
        least = INF
        for initial, cost, j, after in self.edits(i, state):
            if cost + self.least(j, after) <= budget:
                found = self.walk(j, after, budget - cost)
                if found is not None:
                    found.append(initial)
                    return found
            least = min(least, cost + self.least(j, after))
        self.failed[i, state] = least
        return None

    def solve(self, entry: int = 0) -> tuple[int, str]:
        """Cost and edits; INF and nothing if the goal cannot be reached."""
        budget = self.least(0, entry)
        while budget < INF:
            found = self.walk(0, entry, budget)
            if found is not None:
                return budget, "".join(reversed(found))
            budget = self.least(0, entry)
        return INF, ""


def damage(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, turn, role, text, copies): the turns after repeatable damage, or copies 0 for a lost turn.

    Damage goes by CRC-32 of ``conv_id:turn`` modulo 20: 0 loses the turn, 1 empties it, 2
    takes away its full stops, exclamation and question marks, 3 repeats it, 4 makes it the
    user's. A null counts as one space. ``conv`` is "=" and the id, or empty for a null id.
    """
    conv, turn = F.col(id_col).cast("string"), F.col(turn_col).cast("string")
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv, space), F.lit(":"), F.coalesce(turn, space))) % 20
    role = F.coalesce(F.col(role_col).cast("string"), space)
    text = F.coalesce(F.col(text_col).cast("string"), space)
    return conversations.select(
        conversation_key(F.col(id_col)).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def conversation_key(ids: Column) -> Column:
    """Ids as text that is never null and keeps a null apart from every id."""
    return F.coalesce(F.concat(F.lit("="), ids.cast("string")), F.lit(""))


def repair(turns: DataFrame) -> DataFrame:
    """Turns (conv, turn, role, text, copies) as repaired segments.

    A row is a segment: conversation, position (a, b), its turns with their faults, the
    states it begins and ends in, the edits as ``audit`` and their cost. ``whole`` marks
    conversations of one segment that ends them. Turns are taken by ``turn``, nulls first;
    within equal turns by role, then by the text's SHA-256, so equal rows are neighbours.
    A turn with ``copies`` below one does not exist. Faults: blank, duplicate (role and text
    seen earlier in the conversation) and truncated, the first that holds.

    Equal rows of a conversation are combined map-side into one with a number of copies.
    Rows go to tasks by ranges of (conversation, turn, role, digest), so a conversation
    with any share of the rows is spread, and no task holds more than a segment of it. An
    empty table gives no rows.
    """
    parts = stored(_sorted(turns).mapInArrow(_segments, PARTS), "segments")
    whole = parts.where("whole").select("*", F.lit(0).alias("entry"), F.lit(0).alias("exit"), F.lit(0).alias("choice"))
    cut = parts.where("NOT whole").join(_borders(parts), ["conv", "a", "b"])
    cut = cut.select(*parts.columns, "entry", "exit", (F.col("entry") * 4 + F.col("exit")).alias("choice"))
    pick = {"audit": F.get("audits", "choice"), "cost": F.get("costs", "choice")}
    return whole.unionByName(cut).withColumns(pick).drop("audits", "costs", "choice")


def _sorted(turns: DataFrame) -> DataFrame:
    """Distinct turns with ``copies`` and whether they are the first of their kind, in order."""
    present = turns.where("copies > 0").select(
        "conv",
        F.col("turn").isNotNull().alias("timed"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        "role",
        F.sha2("text", 256).alias("digest"),
        "text",
        "copies",
    )
    kind = ["conv", "role", "digest"]
    when = F.min(F.struct("timed", "turn")).alias("at")
    # Stored: an aggregate right under the join would deal the turns out by kind alone, and
    # a frequent kind would stay in one task.
    first = stored(present.groupBy(*kind).agg(when).select(*kind, "at.timed", "at.turn"), "first-turns")
    keys = ["conv", "timed", "turn", "role", "digest"]
    rows = present.groupBy(*keys).agg(F.min("text").alias("text"), F.sum("copies").alias("copies"))
    rows = rows.join(first.withColumn("fresh", F.lit(True)), keys, "left")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return rows.select("conv", "role", "text", F.coalesce("fresh", F.lit(False)).alias("fresh"), "copies")


def _fault(text: str, fresh: bool) -> str:
    seen = text.rstrip(BLANKS)
    if not seen:
        return "blank"
    if not fresh:
        return "duplicate"
    return "" if seen[-1] in ".!?" else "truncated"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the sorted turns of one task, searched."""
    task = TaskContext.get().partitionId()
    schema = pa.schema(
        [("conv", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("whole", pa.bool_()), ("audits", pa.list_(pa.string())), ("costs", pa.list_(pa.int64()))]
        + [("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.string()), ("copies", pa.int64())])))]
    )
    done: list[dict] = []
    size = 0
    before, conv, rows, number = None, None, [], 0

    def close(ended: bool) -> dict:
        # The task's first conversation may have begun in the task before, its last may go on.
        whole = ended and number == 0 and before is not None
        audits, costs = _searched(rows, whole)
        return {"conv": conv, "a": task, "b": number, "whole": whole, "audits": audits, "costs": costs, "rows": rows}

    for batch in batches:
        for i in range(batch.num_rows):
            own, role, text, fresh, copies = (column[i].as_py() for column in batch.columns)
            if conv is not None and (own != conv or len(rows) == SEGMENT):
                done.append(close(own != conv))
                before, number = (conv, 0) if own != conv else (before, number + 1)
                rows = []
            conv = own
            rows.append({"role": role, "text": text, "fault": _fault(text, fresh), "copies": copies})
            size += len(text)
            if size > BATCH_BYTES and done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done, size = [], 0
    if conv is not None:
        done.append(close(False))
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def _searched(rows: list[dict], whole: bool) -> tuple[list[str], list[int]]:
    """Audits and costs: of the whole conversation, or for each (entry, exit)."""
    turns = [(row["role"][:1], row["fault"]) for row in rows]
    if whole:
        found = [Search(turns).solve()]
    else:
        # What a search learns holds for its goal from whatever state it begins in.
        searches = [Search(turns, goal) for goal in STATES]
        found = [searches[goal].solve(entry) for entry in STATES for goal in STATES]
    # Further copies of a row are deleted. They follow it at once: D is the first edit.
    extra = sum(row["copies"] - 1 for row in rows)
    audits = [_with_copies(audit, rows) if extra and cost < INF else audit for cost, audit in found]
    return audits, [cost + DELETE * extra if cost < INF else INF for cost, _ in found]


def _with_copies(audit: str, rows: list[dict]) -> str:
    parts, i = [], 0
    for edit in audit:
        parts.append(edit)
        if edit != "I":
            parts.append("D" * (rows[i]["copies"] - 1))
            i += 1
    return "".join(parts)


def _product(costs: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs and ranks over segments in a row, and the state before each one.

    ``ranks[q, p]`` orders the edits from q by their text. Two different edits of the same
    turns differ before either ends, so edits of segments in a row compare segment by
    segment, and of equally cheap states the one whose edits so far rank first is right.
    """
    cost, rank = costs[0], ranks[0]
    via = np.zeros((len(costs), 4, 4), np.int64)
    for number in range(1, len(costs)):
        sums = cost[:, :, None] + costs[number][None]
        order = rank[:, :, None] * 4 + ranks[number][None]
        new, key = np.full((4, 4), INF), np.zeros((4, 4), np.int64)
        for q in STATES:
            for p in STATES:
                middle = min(STATES, key=lambda m: (sums[q, m, p], order[q, m, p]))
                via[number, q, p] = middle
                new[q, p] = min(sums[q, middle, p], INF)
                key[q, p] = order[q, middle, p]
        cost, rank = new, key.argsort(1, kind="stable").argsort(1, kind="stable")
    return cost, rank, via


def _matrices(group: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    group = group.sort_values(["a", "b"])
    costs, ranks = (np.array(group[name].tolist(), np.int64).reshape(-1, 4, 4) for name in ("costs", "ranks"))
    return group, costs, ranks


def _multiply(group: pd.DataFrame) -> pd.DataFrame:
    group, costs, ranks = _matrices(group)
    cost, rank, _ = _product(costs, ranks)
    head = group.iloc[0]
    return pd.DataFrame([(head["conv"], head["up_a"], head["up_b"], cost.ravel(), rank.ravel())], columns=["conv", "a", "b", "costs", "ranks"])


def _descend(children: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
    """States at the borders inside a group, from those at its ends."""
    children, costs, ranks = _matrices(children)
    _, _, via = _product(costs, ranks)
    entry, state = int(parent["entry"].iloc[0]), int(parent["exit"].iloc[0])
    exits = []
    for number in range(len(children) - 1, -1, -1):
        exits.append(state)
        state = int(via[number, entry, state])
    exits.reverse()
    out = children[["conv", "a", "b"]].copy()
    out["entry"], out["exit"] = [entry, *exits[:-1]], exits
    return out


def _ranked(nodes: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in nodes:
        ranks = []
        for audits in frame["audits"]:
            text = np.array(list(audits), object).reshape(4, 4)
            ranks.append(text.argsort(1, kind="stable").argsort(1, kind="stable").ravel())
        yield frame[["conv", "a", "b", "costs"]].assign(ranks=ranks)


def _borders(parts: DataFrame) -> DataFrame:
    """(conv, a, b, entry, exit) of every segment of a conversation that was cut.

    Each step up combines up to FAN neighbours, first those of one task, then those of
    neighbouring tasks, until a conversation is one matrix. Groups have a bounded size and
    the work of a long conversation is spread over the groups.
    """
    leaves = parts.where("NOT whole").select("conv", "a", "b", "audits", "costs")
    levels = [stored(leaves.mapInPandas(_ranked, NODES), "borders")]
    ups = []
    while True:
        widest = levels[-1].agg(F.max("a"), F.max("b")).first()
        if not (widest[0] or widest[1]):
            break
        inside = bool(widest[1])
        up_a = F.col("a") if inside else F.floor(F.col("a") / FAN)
        up_b = F.floor(F.col("b") / FAN) if inside else F.lit(0).cast("long")
        ups.append(levels[-1].withColumns({"up_a": up_a.cast("long"), "up_b": up_b.cast("long")}))
        levels.append(stored(ups[-1].groupBy("conv", "up_a", "up_b").applyInPandas(_multiply, NODES), "borders"))
    tail = np.array([INSERT * missing for missing in MISSING])

    def last(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            costs, ranks = (np.array(frame[name].tolist(), np.int64).reshape(-1, 16)[:, :4] for name in ("costs", "ranks"))
            exits = [min(STATES, key=lambda p: (cost[p] + tail[p], rank[p])) for cost, rank in zip(costs, ranks)]
            yield frame[["conv", "a", "b"]].assign(entry=0, exit=exits)

    states = levels[-1].mapInPandas(last, BORDERS)
    for children in reversed(ups):
        below = children.groupBy("conv", "up_a", "up_b").cogroup(states.groupBy("conv", "a", "b"))
        states = below.applyInPandas(_descend, BORDERS)
    return states


def repaired(rows: list[dict], audit: str, entry: int) -> list[tuple[str, str]]:
    """(role, text) of the turns that the edits leave."""
    out, i, state, skip = [], 0, entry, 0
    for edit in audit:
        if skip:
            skip -= 1
            continue
        if edit == "I":
            out.append((FOLLOWS[state], ""))
            state = NEXT[state][FOLLOWS[state][0]]
            continue
        row = rows[i]
        if edit != "D":
            role = row["role"] if edit == "K" else FOLLOWS[state]
            out.append((role, row["text"]))
            state = NEXT[state][role[:1]]
        skip, i = row["copies"] - 1, i + 1
    return out


def _ending(state: int) -> list[tuple[str, str]]:
    """Turns inserted after the last segment of a conversation that was cut."""
    return [("user", ""), ("assistant", "")][2 - MISSING[state] :]


def repaired_turns(parts: DataFrame) -> DataFrame:
    """(conv, a, b, place, role, text): the turns of the repaired conversations, in order.

    Turns that a cut conversation lacks at its end are not among them; they follow from
    the ``exit`` of its last segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in batch.to_pylist():
                turns = repaired(part["rows"], part["audit"], part["entry"])
                found += [(part["conv"], part["a"], part["b"], place, *turn) for place, turn in enumerate(turns)]
            columns = list(zip(*found)) or [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["conv", "a", "b", "place", "role", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    return parts.select("conv", "a", "b", "rows", "audit", "entry").mapInArrow(run, "conv string, a long, b long, place long, role string, text string")


def report(parts: DataFrame) -> DataFrame:
    """A row per conversation: its faults, cost, edits and the digest of the repaired turns.

    Conversations of one segment are read as they lie. The segments of others meet in one
    task each, which a digest over a whole conversation asks for, and stream through it in
    order: what the task holds is one segment and the edits so far, a letter per turn.
    """
    columns = ["conv", "whole", "entry", "exit", "audit", "cost", "rows"]
    whole = parts.where("whole").select(*columns)
    cut = parts.where("NOT whole").repartition("conv").sortWithinPartitions("conv", "a", "b").select(*columns)
    return whole.mapInArrow(_reports, REPORT).unionByName(cut.mapInArrow(_reports, REPORT))


class _Report:
    """Running totals of one conversation."""

    def __init__(self, conv: str):
        self.conv, self.cost, self.illegal, self.exit, self.whole = conv, 0, 0, 0, False
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.audit: list[str] = []
        self.digest, self.turns, self.last = hashlib.sha256(), 0, None

    def write(self, turns: list[tuple[str, str]]) -> None:
        for role, text in turns:
            self.digest.update(f"{chr(10) if self.turns else ''}{role}:{text}".encode())
            self.turns += 1

    def add(self, part: dict) -> None:
        for row in part["rows"]:
            fault, copies = row["fault"], row["copies"]
            first = 1 if fault in ("", "truncated") else copies
            if fault:
                self.faults[fault] += first
            self.faults["duplicate"] += copies - first
            initial = row["role"][:1]
            if self.last is not None:
                self.illegal += self.last + initial not in LEGAL
            self.illegal += copies - 1  # a role never follows itself
            self.last = initial
        self.write(repaired(part["rows"], part["audit"], part["entry"]))
        self.cost += part["cost"]
        self.audit.append(part["audit"])
        self.exit, self.whole = part["exit"], part["whole"]

    def row(self) -> tuple:
        if not self.whole:
            ending = _ending(self.exit)
            self.write(ending)
            self.cost += INSERT * len(ending)
            self.audit.append("I" * len(ending))
        return self.conv, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in REPORT.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.string()]
    current = None
    for batch in batches:
        found = []
        for i in range(batch.num_rows):
            part = {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}
            if current is None or current.conv != part["conv"]:
                if current is not None:
                    found.append(current.row())
                current = _Report(part["conv"])
            current.add(part)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), kinds)], names=names)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(current.row(), kinds)], names=names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, damaged and repaired."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = damage(conversations)
    found = report(repair(turns))
    present = F.when(F.col("copies") > 0, F.col("turn")).cast("decimal(20,0)")
    gaps = F.max(present) - F.min(present) + 1 - F.count_distinct(F.when(F.col("copies") > 0, F.col("turn")))
    convs = turns.groupBy("conv").agg(F.coalesce(gaps.try_cast("long"), F.lit(0)).alias("gaps"))
    numbers = [F.coalesce(name, F.lit(0)).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return convs.join(found, "conv", "left").select(
        F.nullif(F.substring("conv", 2, 1 << 30), F.lit("")).cast("long").alias("conv_id"),
        "gaps",
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


#: The same by a dynamic programme: the least (cost, audit) of each state after each turn.
ORACLE_SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), kinds AS (
  SELECT *, xor(4294967295, list_reduce(
           list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda crc, x: list_reduce(
             [CAST(k AS BIGINT) FOR k IN range(8)], lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, x)),
           CAST(4294967295 AS BIGINT))) % 20 AS kind
  FROM src
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS words
  FROM damaged
), turns AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN words = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(words, 1) IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault
  FROM placed
), inserts(q, after, cost, audit, lines) AS (
  VALUES (0, 0, 0, '', []), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
         (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
         (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])
), edits(edit, q, initial, after, cost, role) AS (
  VALUES ('D', 0, NULL, 0, 2, NULL), ('D', 1, NULL, 1, 2, NULL), ('D', 2, NULL, 2, 2, NULL), ('D', 3, NULL, 3, 2, NULL),
         ('K', 0, 's', 1, 0, NULL), ('K', 0, 'u', 2, 0, NULL), ('K', 1, 'u', 2, 0, NULL),
         ('K', 2, 'a', 3, 0, NULL), ('K', 3, 'u', 2, 0, NULL),
         ('R', 0, NULL, 2, 1, 'user'), ('R', 1, NULL, 2, 1, 'user'), ('R', 2, NULL, 3, 1, 'assistant'), ('R', 3, NULL, 2, 1, 'user')
), paths AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, struct_pack(cost := CAST(0 AS BIGINT), audit := '') AS best,
         CAST([] AS VARCHAR[]) AS lines FROM turns
  UNION ALL
  SELECT conv_id, i, q, min(best), arg_min(lines, best) FROM (
    SELECT p.conv_id, t.i, e.after AS q,
           struct_pack(cost := p.best.cost + n.cost + e.cost + CASE WHEN e.edit <> 'D' AND t.fault <> '' THEN 5 ELSE 0 END,
                       audit := p.best.audit || n.audit || e.edit) AS best,
           p.lines || n.lines || CASE WHEN e.edit = 'D' THEN [] ELSE [coalesce(e.role, t.role) || ':' || t.text] END AS lines
    FROM paths p JOIN inserts n ON n.q = p.q
    JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1
    JOIN edits e ON e.q = n.after AND (e.initial IS NULL OR e.initial = t.initial)
         AND (e.edit = 'D' OR t.fault IN ('', 'truncated'))
  ) GROUP BY conv_id, i, q
), ends AS (
  SELECT p.conv_id, min(struct_pack(cost := best.cost + n.cost, audit := best.audit || n.audit)) AS best,
         arg_min(p.lines || n.lines, struct_pack(cost := best.cost + n.cost, audit := best.audit || n.audit)) AS lines
  FROM paths p JOIN inserts n ON n.q = p.q
  JOIN (SELECT conv_id, max(i) AS i FROM turns GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.i = p.i
  WHERE n.after IN (0, 3) GROUP BY p.conv_id
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

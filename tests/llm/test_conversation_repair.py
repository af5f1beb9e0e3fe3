"""Conversation repair against a dynamic programme over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest

from tests.llm.conftest import SMALL
from tributary.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = {"su", "ua", "au"}


def damaged(rows):
    """Rows of each conversation after damage, in order."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest())
    return {conv: sorted(turns, key=order) for conv, turns in convs.items()}


def cheapest(turns, entry=0, goal=None):
    """Least (cost, audit) by states reached after each turn."""

    def with_insertions(best):
        out = dict(best)
        for state, (cost, audit) in best.items():
            for _ in range(2):
                state = 3 if state == 2 else 2
                cost, audit = cost + 5, audit + "I"
                out[state] = min(out.get(state, (cost, audit)), (cost, audit))
        return out

    best = {entry: (0, "")}
    for initial, fault in turns:
        new = {}
        for state, (cost, audit) in with_insertions(best).items():
            ways = [(cost + 2, audit + "D", state)]
            if fault in ("", "truncated"):
                price = cost + 5 * bool(fault)
                follows = {0: "su", 1: "u", 2: "a", 3: "u"}[state]
                if initial and initial in follows:
                    ways.append((price, audit + "K", {"s": 1, "u": 2, "a": 3}[initial]))
                ways.append((price + 1, audit + "R", 3 if state == 2 else 2))
            for a, b, after in ways:
                new[after] = min(new.get(after, (a, b)), (a, b))
        best = new
    if goal is not None:
        return best.get(goal, (repair.INF, ""))
    best = with_insertions(best)
    return min(best[state] for state in (0, 3) if state in best)


def expected(rows):
    out = []
    for conv, turns in damaged(rows).items():
        seen, faults, illegal = set(), [], 0
        for _, role, text in turns:
            words = text.rstrip(" \t\n\x0b\x0c\r")
            if not words:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if words[-1] in ".!?" else "truncated")
            seen.add((role, text))
        for one, two in zip(turns, turns[1:]):
            illegal += one[1][:1] + two[1][:1] not in LEGAL
        cost, audit = cheapest([(role[:1], fault) for (_, role, _), fault in zip(turns, faults)])
        kept, state, at = [], 0, 0
        for edit in audit:
            own = turns[at] if edit != "I" else (None, None, "")
            at += edit != "I"
            if edit == "D":
                continue
            role = own[1] if edit == "K" else ("assistant" if state == 2 else "user")
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            kept.append(f"{role}:{own[2]}")
        known = [turn for turn, _, _ in turns if turn is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        counts = [faults.count(fault) for fault in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def found(spark, tmp_path, rows, extra=()):
    fields = ", ".join([SCHEMA, *(f"{name} string" for name in extra)])
    full = [(*row, *["x"] * len(extra)) for row in rows]
    spark.createDataFrame(full, fields).write.parquet(str(tmp_path / "conversations.parquet"))
    return sorted((tuple(row) for row in repair.query(spark, str(tmp_path)).collect()), key=repr)


def some_rows(seed, convs, longest):
    choose = random.Random(seed)
    texts = ["All good.", "All good", "what?", "no stop", " \t", "", None, "Yes!", "a\nb."]
    rows = []
    for conv in range(convs):
        for turn in range(choose.randint(1, longest)):
            turn = choose.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, turn, choose.choice(["user", "assistant", "assistant", "system", "tool", None, ""]), choose.choice(texts)))
    return rows


def test_search_equals_dynamic_programme():
    choose = random.Random(5)
    for _ in range(400):
        turns = [(choose.choice("suaaux"), choose.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(choose.randint(1, 12))]
        assert repair.Search(turns).solve() == cheapest(turns)
        for goal in repair.STATES:
            search = repair.Search(turns, goal)
            for entry in repair.STATES:
                assert search.solve(entry) == cheapest(turns, entry, goal)


def test_small_conversations(spark, tmp_path):
    rows = some_rows(1, 150, 9) + [(None, 0, "user", "Lost?"), (None, None, None, None)]
    rows += rows[:40]
    assert found(spark, tmp_path, rows, extra=["conv", "rows", "copies", "audit"]) == expected(rows)


@pytest.mark.parametrize("spread", [False, True])
def test_long_conversations_are_cut_and_agree(spark, tmp_path, monkeypatch, spread):
    """One conversation of most rows, over several tasks and levels of the tree."""
    monkeypatch.setattr(repair, "FAN", 3)
    choose = random.Random(9)
    rows = some_rows(2, 6, 9)
    for turn in range(1500):
        text = choose.choice([f"Turn {turn}.", f"Turn {turn}.", f"Turn {turn}", "Same.", ""])
        rows.append((3, turn, choose.choice(["user", "assistant", "assistant", "system"]), text))
    rows += [(4, 5, "user", "Once more.")] * 300
    if spread:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found(spark, tmp_path, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_very_long_text_and_turn_numbers(spark, tmp_path):
    rows = [(1, -(1 << 62), "user", "x " * 400_000 + "."), (1, 1 << 62, "assistant", "y" * 300_000)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, []) == []


def test_repaired_turns_are_the_texts_behind_the_digest(spark, tmp_path):
    rows = some_rows(4, 40, 9)
    parts = repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA)))
    turns = {}
    for row in repair.repaired_turns(parts).orderBy("conv", "a", "b", "place").collect():
        turns.setdefault(row["conv"], []).append(f"{row['role']}:{row['text']}")
    states = {row["conv"]: row["exit"] for row in parts.orderBy("a", "b").collect()}
    for conv, state in states.items():
        turns.setdefault(conv, []).extend(f"{role}:{text}" for role, text in repair._ending(state))
    digests = {conv: hashlib.sha256("\n".join(lines).encode()).hexdigest() for conv, lines in turns.items()}
    assert digests == {row["conv"]: row["repaired_sha256"] for row in repair.report(parts).collect()}


def test_given_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = sorted((tuple(row) for row in repair.query(spark, SMALL).collect()), key=repr)
    assert result == expected(rows)

"""Repairs against the cheapest of all edits, worked out from the last row back."""

from __future__ import annotations

import hashlib
import random
import re
import time
from functools import lru_cache

import pytest

from tablewright.llm import turn_repair

FOLLOWS = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
NAME = {"u": "user", "a": "assistant"}


def faults(rows):
    """(role, text, must go, cut short) per row in order, and the counts."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
    seen, out, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        out.append((role, text, fault in (0, 1), fault == 2))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return out, (gaps, *counts, illegal)


def cheapest(rows):
    @lru_cache(None)
    def rest(k, end, inserts):
        """(cost, letters, turns) from row k on after a turn of that initial."""
        ways = []
        if k == len(rows) and end in ("", "a"):
            ways.append((0, "", ()))
        if k < len(rows):
            role, text, gone, cut = rows[k]
            cost, letters, turns = rest(k + 1, end, 0)
            ways.append((cost + 2, "D" + letters, turns))
            if not gone:
                extra = 5 if cut else 0
                if role[:1] and role[:1] in FOLLOWS[end]:
                    cost, letters, turns = rest(k + 1, role[0], 0)
                    ways.append((cost + extra, "K" + letters, ((role, text), *turns)))
                for new in FOLLOWS[end]:
                    if new != "s":
                        cost, letters, turns = rest(k + 1, new, 0)
                        ways.append((cost + 1 + extra, "R" + letters, ((NAME[new], text), *turns)))
        if inserts < 3:
            for new in FOLLOWS[end]:
                if new != "s":
                    cost, letters, turns = rest(k, new, inserts + 1)
                    ways.append((cost + 5, "I" + letters, ((NAME[new], ""), *turns)))
        return min(ways, default=(10**9, "", ()))

    return rest(0, "", 0)


def wanted(rows):
    marked, counts = faults(rows)
    cost, audit, turns = cheapest(tuple(marked))
    said = "\n".join(f"{r}:{t}" for r, t in turns)
    return (*counts, cost, audit, hashlib.sha256(said.encode()).hexdigest(), len(rows), len(turns))


def conversations():
    rnd = random.Random(13)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "User"]
    said = ["Yes.", "no", "What? ", "ok!\n", "", " \t", None, "é", "a. ", "x\n.", "long " * 50 + "."]
    out = {c: [(rnd.choice([None, *range(6)]) if rnd.random() < 0.3 else t, rnd.choice(roles), rnd.choice(said)) for t in range(rnd.randint(1, 9))] for c in range(400)}
    for c in range(400, 700):
        out[c] = [(t, rnd.choice(["user", "assistant", "system"]), f"Turn {rnd.randint(0, 6)}" + rnd.choice([".", "", "!"])) for t in range(rnd.randint(1, 12))]
    out[None] = [(0, "user", "hm."), (1, "assistant", "hm."), (2**62 + 1, "user", "hm!")]
    out[2**60 + 1] = [(2**62 + 1, "user", "a."), (2**62 + 3, "assistant", "b.")]
    return out


@pytest.mark.parametrize("batch", [3, 10_000])
def test_repairs_are_the_cheapest(spark, monkeypatch, batch):
    monkeypatch.setattr(turn_repair, "SPOOL_BYTES", 40)
    monkeypatch.setattr(turn_repair, "DIGESTS", 2)
    monkeypatch.setattr(turn_repair, "BLOCK_ROWS", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        held = conversations()
        rows = [(c, t, r, x, "z") for c, turns in held.items() for t, r, x in turns]
        random.Random(1).shuffle(rows)
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
        got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(frame).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {c: wanted(turns) for c, turns in held.items()}


def test_conversations_without_rows(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a.", False), (2, 0, "user", "b.", True), (2, 1, "user", "c.", None)],
                                  "conv_id long, turn long, role string, text string, there boolean")
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(frame, present="there").collect()}
    assert got == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0, 0), 2: wanted([(0, "user", "b.")])}
    assert turn_repair.repair(frame.drop("there").limit(0)).count() == 0


def test_a_conversation_of_many_turns(spark):
    n = 100_000
    frame = spark.range(n).selectExpr("7L as conv_id", "id as turn", "if(id % 4 = 1, 'assistant', 'user') as role", "concat('say ', id, '.') as text")
    start = time.time()
    (row,) = turn_repair.repair(frame).collect()
    assert time.time() - start < 60
    assert row.n_rows == n and row.cost == n // 4 and row.audit == "KKKR" * (n // 4) and row.illegal == n // 2 - 1

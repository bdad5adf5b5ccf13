"""Ranked search against scores of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def ranking(docs, queries, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in held]
    n, whole = sum(x > 0 for x in lengths), sum(lengths)
    out = []
    for item, text in queries:
        asked = Counter(terms(text))
        scored = []
        for (doc, have), length in zip(held, lengths, strict=True):
            score = 0
            for term, times in asked.items():
                if have[term]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * sum(term in c for _, c in held) + 1)))
                    score += times * weight * ((10**9 * have[term]) // (1000 * have[term] + 8 * (25 + (75 * length * n) // whole)))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, rank + 1, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [300, 8 << 20])
def test_rows_match_scores_of_all_documents(spark, monkeypatch, shard):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(lexical_search, "QUERY_BLOCK", 7)
    rnd = random.Random(3)
    words = ["the", "Of", "and", "x1", "straße", "ÉTÉ", "été", "İ", "漢字", "a_b", "don't", *(f"w{i}" for i in range(60))]
    chances = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rnd.choices(words, chances, k=rnd.randint(0, 60)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "!!!"), (None, "no id w5 w6"), (5, docs[5][1]), (5, docs[5][1]), (203, "the " * 3000), (204, docs[7][1])]
    queries = [(q, " ".join(rnd.choices(words, k=rnd.randint(1, 25)))) for q in range(25)]
    queries += [(30, None), (31, ""), (32, "unknownword"), (33, "the the of"), (None, "w1 w2"), (34, " ".join(words))]
    made = spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, shard long, term long").repartition(3)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    for k in (1, 3, 10):
        got = lexical_search.search(lexical_search.index(made), asked, k).collect()
        assert sorted(map(tuple, got), key=repr) == ranking(docs, queries, k)


def test_accumulators_stop_but_scores_stay_exact():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        n, k = int(rnd.integers(1, 40)), int(rnd.integers(1, 6))
        lists = []
        for _ in range(int(rnd.integers(1, 8))):
            docs = np.flatnonzero(rnd.random(n) < rnd.random())
            lists.append((docs, rnd.integers(1, 50, len(docs))))
        lists = [x for x in sorted(lists, key=lambda x: len(x[0])) if len(x[0])]
        whole = np.zeros(n, np.int64)
        for docs, share in lists:
            whole[docs] += share
        found, score = lexical_search.accumulate(lists, [int(s.max()) for _, s in lists], n, k)
        assert len(set(found.tolist())) == len(found) and (score == whole[found]).all()
        wanted = np.lexsort((np.arange(n), -whole))[:k]
        assert {d for d in wanted.tolist() if whole[d]} <= set(found.tolist())
    # A frequent term opens nothing once a rare one has filled the first place.
    found, score = lexical_search.accumulate([(np.array([4]), np.array([90])), (np.arange(30), np.full(30, 5))], [90, 5], 30, 1)
    assert found.tolist() == [4] and score.tolist() == [95]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none, nothing = docs.limit(0), spark.createDataFrame([], "item_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(lexical_search.index(none), asked).count() == 0
    assert lexical_search.search(lexical_search.index(docs), nothing).count() == 0
    assert lexical_search.search(lexical_search.index(docs), asked).count() == 1

"""Work in rounds gives the rows of one round, and what no later step reads leaves the disk."""

from __future__ import annotations

import os
import time

import numpy as np

from tablewright.operators import decomposition as D
from tablewright.operators import products as PR
from tablewright.operators import recsys as K
from tablewright.operators import retrieval as V
from tablewright.sources import tables as T


def shuffle_blocks(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {b for b in manager.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}


def noted(monkeypatch, module):
    """The labels and tables that a module writes from here on."""
    made = []

    def put(df, label):
        table = T.stored(df, label)
        made.append((label, table))
        return table

    monkeypatch.setattr(module, "stored", put)
    return made


def ratings(spark, users=60, films=40, seed=5):
    """Every user rates ten films near in number, so keys that are near meet."""
    rng = np.random.default_rng(seed)
    rows = [(u, (u * films // users + int(f)) % films, float(rng.integers(1, 6))) for u in range(users) for f in rng.permutation(14)[:10]]
    return spark.createDataFrame(rows, "userId long, movieId long, rating double")


def rows_of(df, digits=9):
    return sorted((tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_stored_frees_its_shuffle_files(spark):
    before = shuffle_blocks(spark)
    held = spark.range(5000).groupBy((T.F.col("id") % 97).alias("k")).count()
    table = T.stored(held, "counts")
    end = time.time() + 20
    while shuffle_blocks(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_blocks(spark) - before
    assert table.count() == 97 and held.count() == 97
    assert spark.conf.get(T.SHUFFLE_CLEANUP, "false") == "false"
    T.dropped(table)
    assert not os.path.exists(table.stored_path)


def test_neighbours_and_weighted_lists_in_rounds(spark, monkeypatch):
    train = ratings(spark)
    near = K.cosine_neighbours(train, "movieId", "userId", 5).localCheckpoint()
    by_item = rows_of(K.item_knn_topk(train, near))
    users = K.cosine_neighbours(train, "userId", "movieId", 5).localCheckpoint()
    by_user = rows_of(K.user_knn_topk(train, users))
    made = noted(monkeypatch, PR)
    monkeypatch.setattr(PR, "ROUND_ENTRIES", 700)
    assert rows_of(K.cosine_neighbours(train, "movieId", "userId", 5)) == rows_of(near)
    assert sum(label == "nearest" for label, _ in made) > 1
    # What only the search reads is gone when it is done.
    assert [label for label, table in made if os.path.exists(table.stored_path)] == ["nearest"] * sum(label == "nearest" for label, _ in made)
    made.clear()
    assert rows_of(K.item_knn_topk(train, near)) == by_item
    assert rows_of(K.user_knn_topk(train, users)) == by_user
    assert sum(label == "lists" for label, _ in made) > 4
    # Near users have near films: a film's list goes to few of the eight ranges.
    asked = next(table for label, table in made if label == "asked")
    assert asked.count() <= 4 * train.select("movieId").distinct().count()


def test_predictions_in_rounds(spark, monkeypatch):
    train = ratings(spark)
    near = K.cosine_neighbours(train, "movieId", "userId", 5).localCheckpoint()
    pairs = spark.createDataFrame([(u, (u * 7) % 40, 3.0) for u in range(62)] + [(None, 1, 2.0), (3, None, 2.0)], "userId long, movieId long, rating double")
    whole = rows_of(K.item_knn_predictions(train, near, pairs))
    made = noted(monkeypatch, K)
    monkeypatch.setattr(K, "ROUND_PAIRS", 20)
    assert rows_of(K.item_knn_predictions(train, near, pairs)) == whole
    assert [label for label, _ in made] == ["scores"] * 4


def test_vector_search_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(2)
    items = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(70)], "i long, v array<double>")
    items = items.unionByName(items.where("i % 5 = 0").withColumn("i", T.F.col("i") + 100))
    queries = spark.createDataFrame([(q, rng.normal(size=4).tolist()) for q in range(50)], "q long, v array<double>")
    seen = spark.createDataFrame([(q, (3 * q) % 70) for q in range(50)], "q long, i long")
    search = lambda: rows_of(V.block_topk(queries, items, 4, "q", "i", "v", "v", seen=seen, block_rows=8))
    whole = search()
    made = noted(monkeypatch, V)
    monkeypatch.setattr(V, "ROUND_BYTES", 20000)
    assert search() == whole
    assert sum(label == "matches" for label, _ in made) > 1


def test_decomposition_keeps_two_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    entries = spark.createDataFrame([(i, j, float(rng.normal())) for i in range(12) for j in range(9)], "r long, c long, x double")
    made = noted(monkeypatch, D)
    rows, columns, values = D.truncated_decomposition(entries, "r", "c", "x", 3, iterations=3, tolerance=0.0)
    assert len([label for label, _ in made if label == "block"]) > 8
    assert [label for label, table in made if os.path.exists(table.stored_path)] == ["block"] * 2
    dense = np.zeros((12, 9))
    for r, c, x in entries.collect():
        dense[r, c] = x
    assert np.allclose(values, np.linalg.svd(dense, compute_uv=False)[:3], rtol=0.05)
    assert rows.count() == 12 and columns.count() == 9

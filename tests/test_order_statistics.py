"""Exact order statistics, blocks and draws against brute force on skewed small frames."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.functions import ladders as L
from tablewright.operators import metrics as E
from tablewright.operators import products as PR
from tablewright.operators import recsys as K
from tablewright.operators import retail as R
from tablewright.operators import retrieval as V
from tablewright.operators import sampling as S
from tablewright.operators import text as X
from tablewright.operators import windows as W


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key, and half of these share one value."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        key = "hot" if hot else f"k{i % 17}"
        value = 7.0 if hot and i % 2 else float(np.round(rng.normal(0, 5), 2))
        rows.append((i, key, value))
    return spark.createDataFrame(rows, "id long, key string, v double").repartition(6)


def test_quantiles_equal_numpy(skewed):
    ps = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.97, "e": 1.0}
    pdf = skewed.toPandas()
    row = L.quantiles(skewed, "v", ps).first()
    assert [row[n] for n in ps] == pytest.approx(list(np.quantile(pdf["v"], list(ps.values()))))
    for r in L.quantiles(skewed, "v", ps, ("key",)).collect():
        group = pdf.loc[pdf["key"] == r["key"], "v"]
        assert [r[n] for n in ps] == pytest.approx(list(np.quantile(group, list(ps.values()))))


def test_average_ranks_equal_pandas(skewed):
    pdf = skewed.toPandas()
    pdf["rank"] = pdf["v"].rank(method="average")
    got = {r["v"]: r["rank"] for r in L.average_rank(skewed, "v").collect()}
    assert got == {v: r for v, r in zip(pdf["v"], pdf["rank"])}


def test_global_rank_is_a_permutation(skewed):
    ranked = L.global_rank(skewed, "v", "id").toPandas().sort_values("rank")
    assert list(ranked["rank"]) == list(range(1, 3001))
    expected = skewed.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert list(ranked["id"]) == list(expected["id"])


def test_split_row_number_equals_plain_window(skewed):
    pieced = L.with_value_piece(skewed, "v")
    got = L.split_row_number(pieced, ("key",), [F.col("v"), F.col("id")], "rn", "_piece", total="n").toPandas()
    want = skewed.toPandas().sort_values(["v", "id"])
    want["rn"] = want.groupby("key").cumcount() + 1
    merged = got.merge(want, on="id")
    assert (merged["rn_x"] == merged["rn_y"]).all()
    assert (got.groupby("key")["n"].max() == want.groupby("key").size()).all()


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "v double")
    assert L.ladder(empty, "v").count() == 0
    assert L.quantiles(empty, "v", {"m": 0.5}).first()["m"] is None


@pytest.fixture(scope="module")
def ratings(spark):
    """One user rated every item and one item was rated by every user."""
    rng = np.random.default_rng(9)
    rows = {}
    for m in range(60):
        rows[(0, m)] = float(rng.integers(1, 11)) / 2
    for u in range(40):
        rows[(u, 3)] = float(rng.integers(1, 11)) / 2
        for m in rng.choice(60, size=int(rng.integers(1, 12)), replace=False):
            rows[(u, int(m))] = float(rng.integers(1, 11)) / 2
    data = [(u, m, r) for (u, m), r in rows.items()]
    return spark.createDataFrame(data, "userId long, movieId long, rating double").repartition(5)


def matrix(ratings):
    pdf = ratings.toPandas()
    x = np.zeros((40, 60))
    x[pdf["userId"], pdf["movieId"]] = pdf["rating"]
    return x


@pytest.mark.parametrize("work", [1 << 22, 200, 10])
@pytest.mark.parametrize("held", [1 << 21, 50])
def test_neighbours_equal_dense_product(ratings, work, held, monkeypatch):
    monkeypatch.setattr(PR, "HELD_PRODUCTS", held)
    monkeypatch.setattr(PR, "PART_ENTRIES", 7)
    got = PR.nearest_rows(ratings, "movieId", "userId", "rating", 5, work).toPandas()
    x = matrix(ratings)
    unit = x / np.maximum(np.linalg.norm(x, axis=0), 1e-12)
    sim = np.round(unit.T @ unit, 9)
    np.fill_diagonal(sim, 0)
    for item in range(60):
        best = [j for j in sorted(range(60), key=lambda j: (-sim[item, j], j)) if sim[item, j] > 0][:5]
        mine = got[got["movieId"] == item]
        assert set(mine["neighbour"]) == set(best)
        assert sorted(mine["sim"]) == pytest.approx(sorted(sim[item, best]))


@pytest.mark.parametrize("work", [1 << 22, 1])
def test_neighbours_of_opposite_ratings(spark, work):
    """Common users whose products cancel still make two items neighbours, whatever the blocks."""
    rows = [(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0), (2, 2, -1.0), (3, 3, 2.0)]
    data = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    got = PR.nearest_rows(data, "movieId", "userId", "rating", 5, work).collect()
    assert sorted((r.movieId, r.neighbour, round(r.sim, 12)) for r in got) == [(1, 2, 0.0), (2, 1, 0.0)]


def test_hybrid_of_equal_scores(spark):
    """Items that one scorer cannot tell apart have no deviation: the other scorer decides, over the items both know."""
    users_a = spark.createDataFrame([(1, [0.3, 4.0])], "userId long, profile array<double>")
    items_a = spark.createDataFrame([(i, [1.0e8, 1.0]) for i in range(1000)], "movieId long, embedding array<double>")
    users_b = spark.createDataFrame([(1, [1.0])], "userId long, profile array<double>")
    items_b = spark.createDataFrame([(i, [float(i)]) for i in range(900)] + [(5000, [1e9])], "movieId long, embedding array<double>")
    got = K.hybrid_topk(users_a, items_a, users_b, items_b, 0.5, 3).orderBy("rank").collect()
    assert [r.movieId for r in got] == [899, 898, 897]
    assert got[0].score == pytest.approx(0.5 * (899 - 449.5) / np.arange(900).std())


def test_popularity_lists_equal_brute_force(spark, ratings):
    users = spark.createDataFrame([(u,) for u in [*range(40), 99]], "userId long")
    got = K.popularity_topk(ratings, users, 4).toPandas()
    pdf = ratings.toPandas()
    n = pdf.groupby("movieId").size()
    order = sorted(n.index, key=lambda m: (-n[m], m))
    for u in [*range(40), 99]:
        seen = set(pdf.loc[pdf["userId"] == u, "movieId"])
        want = [m for m in order if m not in seen][:4]
        assert list(got[got["userId"] == u].sort_values("rank")["movieId"]) == want


def test_negatives_are_unseen_and_complete(ratings):
    got = K.negatives(ratings, 4).toPandas()
    pdf = ratings.toPandas()
    seen = set(zip(pdf["userId"], pdf["movieId"]))
    assert not [p for p in zip(got["userId"], got["negative"]) if p in seen]
    full = set(pdf.groupby("userId").size().loc[lambda s: s == 60].index)
    liked = pdf[(pdf["rating"] >= 3.5) & ~pdf["userId"].isin(full)]
    assert len(got) == 4 * len(liked)
    again = K.negatives(ratings.repartition(3), 4).toPandas()
    key = ["userId", "movieId", "draw"]
    assert got.sort_values(key)["negative"].tolist() == again.sort_values(key)["negative"].tolist()


@pytest.mark.parametrize("rows", [4096, 6])
def test_block_search_equals_dense_product(spark, rows):
    rng = np.random.default_rng(2)
    q, i = rng.normal(size=(20, 5)), rng.normal(size=(31, 5))
    queries = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(q)], "q long, v array<double>")
    items = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(i)], "i long, v array<double>")
    seen = spark.createDataFrame([(k, (k * 3 + d) % 31) for k in range(20) for d in range(12)], "q long, i long")
    got = V.block_topk(queries, items, 4, "q", "i", "v", "v", seen=seen, block_rows=rows).toPandas()
    scores = q @ i.T
    for k in range(20):
        for d in range(12):
            scores[k, (k * 3 + d) % 31] = -np.inf
        want = list(np.argsort(-scores[k])[:4])
        assert list(got[got["query_id"] == k].sort_values("rank")["item_id"]) == want


def test_few_neighbours_leave_a_cell(ratings):
    """With an item in one cell only its k best are shuffled; signed values keep the lists exact in many cells."""
    signed = ratings.withColumn("rating", F.col("rating") - 3).where("rating <> 0")
    lists = [{(r.movieId, r.neighbour, round(r.sim, 9)) for r in PR.nearest_rows(signed, "movieId", "userId", "rating", 3, w).collect()} for w in (1 << 22, 5)]
    assert lists[0] == lists[1]
    x = np.zeros((40, 60))
    for r in signed.collect():
        x[r.userId, r.movieId] = r.rating
    x *= np.random.default_rng(1).uniform(0.9, 1.1, x.shape)  # no ties
    left = pa.table({"f": np.nonzero(x)[0], "i": np.nonzero(x)[1], "x": x[np.nonzero(x)], "cuts": np.ones((x != 0).sum(), np.int32)})
    lists = [[{"i": int(i), "x": float(x[u, i])} for i in np.flatnonzero(x[u])] for u in range(40)]
    right = pa.table({"f": pa.array(range(40)), "list": pa.array(lists, pa.list_(pa.struct([("i", pa.int64()), ("x", pa.float64())])))})
    sent = PR._cell_neighbours(left, right, 3)
    assert 0 < sent.num_rows <= 3 * 60


@pytest.mark.parametrize("work", [1 << 24, 300, 5])
@pytest.mark.parametrize("held", [1 << 21, 40])
def test_weighted_lists_equal_plain_sums(ratings, spark, work, held, monkeypatch):
    """Blocks, cut blocks and long lists give the lists of a plain join; a null user, a null rating and a null target count as in SQL."""
    monkeypatch.setattr(PR, "HELD_PRODUCTS", held)
    monkeypatch.setattr(PR, "PART_ENTRIES", 7)
    odd = spark.createDataFrame([(None, 3, 4.0), (None, 5, 1.0), (41, 4, None), (42, None, 2.0)], "userId long, movieId long, rating double")
    train = ratings.unionByName(odd)
    pairs = [(m, (m * 7 + d) % 60, round(((m + d) % 11 - 4) / 7, 9)) for m in range(60) for d in range(1, 9)] + [(3, None, 0.5)]
    links = spark.createDataFrame(pairs, "movieId long, neighbour long, sim double").withColumnRenamed("movieId", "m")
    got = PR.weighted_topk(train.withColumnRenamed("movieId", "m"), links, "userId", "m", "rating", "neighbour", "sim", "sim", 6, train.withColumnRenamed("movieId", "neighbour"), work)
    train.createOrReplaceTempView("tr_w")
    links.createOrReplaceTempView("links_w")
    want = spark.sql("""
    with s as (select userId, neighbour, try_divide(sum(sim * rating), sum(abs(sim))) as score from tr_w join links_w on movieId = m group by 1, 2),
    u as (select * from s where not exists (select 1 from tr_w t where t.userId <=> s.userId and t.movieId <=> s.neighbour)),
    r as (select *, row_number() over (partition by userId order by floor(score * 1e9 + 0.5) desc, neighbour) as rank from u)
    select * from r where rank <= 6""")
    told = lambda df: {(r.userId, r.neighbour, r.rank): r.score for r in df.collect()}
    mine, plain = told(got), told(want)
    assert mine.keys() == plain.keys() and any(u is None for u, _, _ in mine) and any(n is None for _, n, _ in mine)
    assert all(mine[key] == (v if v is None else pytest.approx(v)) for key, v in plain.items())


def test_products_stay_in_their_cell(ratings):
    """What leaves a cell of whole rows is k rows for each, not one for every product."""
    rows = ratings.toPandas()
    left = pa.table({"r": rows["userId"], "c": rows["movieId"], "x": rows["rating"], "mark": np.zeros(len(rows), np.int32), "cuts": np.ones(len(rows), np.int32)})
    kind = pa.list_(pa.struct([("t", pa.int64()), ("y", pa.float64())]))
    right = pa.table({"c": pa.array(range(60)), "list": pa.array([[{"t": t, "y": 0.5} for t in range(50)]] * 60, kind)})
    assert PR._cell_weighted(left, right, 3, False).num_rows == 3 * 40


@pytest.mark.parametrize("block", [4096, 6])
def test_sparse_product_equals_dense(ratings, spark, block, monkeypatch):
    monkeypatch.setattr(PR, "BLOCK_ROWS", block)
    monkeypatch.setattr(PR, "CELL_ENTRIES", 5 * block)
    rng = np.random.default_rng(12)
    dense = rng.normal(size=(60, 4))
    rows = [(m, v.tolist()) for m, v in enumerate(dense) if m != 7] + [(7, None), (99, [1.0] * 4)]
    frame = spark.createDataFrame(rows, "movieId long, v array<double>")
    got = {r.userId: r["product"] for r in PR.sparse_times_dense(ratings, frame, "userId", "movieId", "rating", "v").collect()}
    x = matrix(ratings)
    x[:, 7] = 0
    for u in range(40):
        assert got[u] == pytest.approx(list(x[u] @ dense)) if x[u].any() else u not in got
    total = PR.gram(frame.where("v is not null"), "v", 4)
    kept = np.vstack([np.delete(dense, 7, 0), np.ones(4)])
    assert total == pytest.approx(kept.T @ kept)
    turned = PR.times_matrix(frame.where("v is not null"), "movieId", "v", np.diag([1.0, 2, 3, 4])).where("movieId = 99").first()
    assert turned["v"] == [1.0, 2.0, 3.0, 4.0]


def test_content_lists_of_items_and_users_without_vectors(spark):
    items = spark.createDataFrame([(1, [3.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0])], "movieId long, embedding array<double>")
    train = spark.createDataFrame([(1, 1, 4.0), (1, 8, 2.0), (2, 9, 5.0)], "userId long, movieId long, rating double")
    users = spark.createDataFrame([(1,), (2,), (3,)], "userId long")
    films = spark.createDataFrame([(i,) for i in (1, 2, 3, 8, 9)], "movieId long")
    got = {}
    for r in K.content_topk(train, items, 4, users, films).orderBy("rank").collect():
        got.setdefault(r.userId, []).append((r.movieId, round(r.score, 6)))
    assert got[1] == [(3, 0.707107), (2, 0.0), (9, -1.0)]
    assert got[2] == [(1, 0.0), (2, 0.0), (3, 0.0), (8, -1.0)]
    assert got[3] == [(1, 0.0), (2, 0.0), (3, 0.0), (8, -1.0)]


def test_far_clusters_are_not_visited(spark, monkeypatch):
    rng = np.random.default_rng(3)
    axes = np.eye(16) * 10
    points = np.concatenate([a + rng.normal(size=(40, 16)) * 0.1 for a in axes])
    items = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(points)], "i long, v array<double>")
    queries = spark.createDataFrame([(k, (axes[k % 16] + rng.normal(size=16) * 0.1).tolist()) for k in range(64)] + [(99, [0.0] * 16), (100, None)], "q long, v array<double>")
    visits, scored = [], V._scored
    monkeypatch.setattr(V, "_scored", lambda v, *rest: (visits.append(v.count()), scored(v, *rest))[1])
    got = V.block_topk(queries, items, 5, "q", "i", "v", "v", block_rows=40).toPandas()
    vectors = {r.q: np.array(r.v) for r in queries.where("v is not null").collect()}
    for q, v in vectors.items():
        want = np.lexsort((np.arange(640), -np.round(points @ v, 9)))[:5]
        assert list(got[got["query_id"] == q].sort_values("rank")["item_id"]) == list(want)
    # Each query sees the block of its own direction; only the zero vector, whose scores all tie, goes everywhere.
    assert visits[0] == 65 and visits[1] <= 64 * 3 + 20


def test_lists_over_equal_vectors(spark, monkeypatch):
    """Items of one vector are one class: unseen members come by id, seen ones drop out, and distinct vectors may tie."""
    monkeypatch.setattr(V, "HELD_SCORES", 64)
    vectors = [[1.0, 0.0], [0.0, 1.0], [0.5, 0.5], [0.0, 1.0], [2.0, -1.0]]
    items = spark.createDataFrame([(i, vectors[i % 5]) for i in range(60)], "i long, v array<double>")
    profiles = {0: [1.0, 1.0], 1: [1.0, 0.0], 2: [0.0, 0.0], 3: [-1.0, 2.0]}
    queries = spark.createDataFrame(list(profiles.items()), "q long, v array<double>")
    hidden = {0: set(range(0, 30)), 1: {4, 9, 14, 59}, 2: {0, 1, 2, 7}, 3: set(range(60)) - {5, 8, 44}}
    seen = spark.createDataFrame([(q, i) for q, s in hidden.items() for i in s], "q long, i long")
    for rows in (None, 1):
        got = V.block_topk(queries, items, 7, "q", "i", "v", "v", seen=seen, block_rows=rows).orderBy("rank").collect()
        for q, v in profiles.items():
            score = {i: float(np.dot(v, vectors[i % 5])) for i in range(60) if i not in hidden[q]}
            assert [r.item_id for r in got if r.query_id == q] == sorted(score, key=lambda i: (-score[i], i))[:7]


def test_equal_vectors_are_scored_once(spark, monkeypatch):
    sent, scored = [], V._scored
    monkeypatch.setattr(V, "_scored", lambda v, items, *rest: (sent.append(items.count()), scored(v, items, *rest))[1])
    items = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(300)], "i long, v array<double>")
    assert V.block_topk(items.limit(5), items, 4, "i", "i", "v", "v", exclude_self=True).count() == 20
    assert max(sent) == 3


def test_user_lists_equal_dense_sums(ratings, spark):
    near = {u: {(u + d) % 40: round(d / 11, 9) for d in range(1, 7)} for u in range(40)}
    links = spark.createDataFrame([(u, v, s) for u, l in near.items() for v, s in l.items()], "userId long, neighbour long, sim double")
    got = {(r.userId, r["rank"]): (r.movieId, r.score) for r in K.user_knn_topk(ratings, links, 5).collect()}
    x = matrix(ratings)
    for u in range(40):
        score = {}
        for m in np.flatnonzero(x[u] == 0):
            by = [v for v in near[u] if x[v, m]]
            if by:
                score[m] = sum(near[u][v] * x[v, m] for v in by) / sum(near[u][v] for v in by)
        for rank, m in enumerate(sorted(score, key=lambda m: (-np.floor(score[m] * 1e9 + 0.5), m))[:5], 1):
            assert got[(u, rank)] == (m, pytest.approx(score[m]))


def test_pair_products_equal_dense(ratings, spark, monkeypatch):
    """Each pair has its own product, in cut blocks and over shared and null vectors; sides without a row drop out."""
    monkeypatch.setattr(PR, "CELL_ENTRIES", 5)
    rng = np.random.default_rng(8)
    u, m = rng.normal(size=(40, 4)), rng.normal(size=(9, 4))[np.arange(60) % 9]
    users = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(u) if k != 6], "userId long, p array<double>")
    items = spark.createDataFrame([(k, v.tolist() if k != 5 else None) for k, v in enumerate(m) if k != 3], "movieId long, e array<double>")
    got = {(r.userId, r.movieId): r.score for r in PR.pair_dots(ratings, users, items, "userId", "movieId", "p", "e").collect()}
    want = {(r.userId, r.movieId): None if r.movieId == 5 else pytest.approx(float(u[r.userId] @ m[r.movieId])) for r in ratings.collect() if r.userId != 6 and r.movieId != 3}
    assert got == want


def test_pair_products_send_no_vector_per_pair(ratings, spark):
    """A vector that many pairs share goes to a block once."""
    users = spark.createDataFrame([(k, [1.0] * 64) for k in range(40)], "userId long, p array<double>")
    items = spark.createDataFrame([(k, [2.0] * 64) for k in range(60)], "movieId long, e array<double>")
    plan = PR.pair_dots(ratings, users, items, "userId", "movieId", "p", "e")
    assert plan.where("score <> 128").count() == 0 and plan.count() == ratings.count()
    assert "aggregate(zip_with" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_similar_items_leave_self_out(spark, tables):
    got = V.similar_items(tables.embeddings, 5, "vec_id", "embedding")
    assert got.where("query_id = item_id").count() == 0
    assert got.groupBy("query_id").count().where("count <> 5").count() == 0


def test_area_under_curve_with_ties(spark):
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 400), np.round(rng.random(400), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert E.auc(df, "y", "p").first()["auc"] == pytest.approx(want)


def test_conformal_coverage(spark):
    rng = np.random.default_rng(1)
    cal = spark.createDataFrame([(float(v), 0.0) for v in rng.normal(size=1000)], "y double, p double")
    new = spark.createDataFrame([(float(v), 0.0) for v in rng.normal(size=500)], "y double, p double")
    radius = E.conformal_radius(cal, "y", "p", 0.1).scalar()
    assert E.coverage(new, "y", "p", radius).first()["coverage"] >= 0.85


def test_split_shares(spark):
    df = spark.range(10000)
    got = {r["s"]: r["n"] for r in df.groupBy(S.random_split("id", {"train": 0.7, "val": 0.15, "test": 0.15}).alias("s")).agg(
        F.count("*").alias("n")).collect()}
    assert sum(got.values()) == 10000
    for name, share in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
        assert abs(got[name] / 10000 - share) < 0.02


def test_groups_never_straddle_folds(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"))
    folded = S.group_folds(df, "g", 5)
    assert folded.count() == 5000
    assert folded.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n <> 1").count() == 0
    assert folded.select("fold").distinct().count() == 5


def test_leave_last_out_on_a_small_history(spark):
    rows = [(1, m, 4.0, f"2020-01-{m + 1:02d}") for m in range(12)] + [(2, m, 3.0, f"2020-02-{m + 1:02d}") for m in range(9)]
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double, d string").withColumn("rated_at", F.to_timestamp("d")).drop("d")
    got = {(r["userId"], r["movieId"]): r["split"] for r in W.leave_last_out(df).collect()}
    assert [got[(1, m)] for m in range(12)] == [0] * 8 + [1, 1, 2, 2]
    assert {got[(2, m)] for m in range(9)} == {0}


def test_search_equals_brute_force(spark):
    docs = ["red fish blue fish", "one fish", "blue sky", "red red wine", "nothing here"]
    d = spark.createDataFrame(list(enumerate(docs)), "d long, text string")
    q = spark.createDataFrame([(0, "red fish"), (1, "sky")], "q long, text string")
    vocab = sorted({w for t in docs for w in t.split()})
    df = {w: sum(w in t.split() for t in docs) for w in vocab}

    def vector(text):
        return np.array([text.split().count(w) * (np.log((1 + len(docs)) / (df[w] + 1)) + 1) for w in vocab])

    got = X.search(q, d, 5, "q", "d").toPandas()
    for k, text in ((0, "red fish"), (1, "sky")):
        v = vector(text)
        for _, r in got[got["q"] == k].iterrows():
            w = vector(docs[int(r["d"])])
            assert r["score"] == pytest.approx(v @ w / np.linalg.norm(v) / np.linalg.norm(w))


@pytest.mark.parametrize("first", [1, 20])
def test_pruned_search_equals_scores_of_all_documents(spark, first):
    rng = np.random.default_rng(21)
    words = np.array(["the", "of", "and", *[f"w{i}" for i in range(80)]])
    chance = 1 / np.arange(1, len(words) + 1)
    docs = [" ".join(rng.choice(words, size=int(rng.integers(0, 40)), p=chance / chance.sum())) for _ in range(150)]
    asked = [" ".join(rng.choice(words, size=int(rng.integers(1, 12)))) for _ in range(20)] + [docs[7], "unknown", ""]
    df = {w: sum(w in t.split() for t in docs) for w in words}

    def vector(text):
        return np.array([text.split().count(w) * (np.log((1 + len(docs)) / (df[w] + 1)) + 1) * (df[w] > 0) for w in words])

    d = spark.createDataFrame(list(enumerate(docs)), "d long, text string")
    q = spark.createDataFrame(list(enumerate(asked)), "q long, text string")
    got = {}
    for r in X.search(q, d, 3, "q", "d", first).collect():
        got.setdefault(r.q, {})[r["rank"]] = (r.d, round(r.score, 9))
    all_docs = np.array([vector(t) for t in docs])
    for k, text in enumerate(asked):
        v = vector(text)
        lengths = np.linalg.norm(v) * np.linalg.norm(all_docs, axis=1)
        score = np.round(np.divide(all_docs @ v, lengths, out=np.zeros(len(docs)), where=lengths > 0), 9)
        best = [i for i in np.lexsort((np.arange(len(docs)), -score))[:3] if score[i] > 0]
        assert [i for i, _ in (got.get(k, {})[p] for p in sorted(got.get(k, {})))] == best


def test_rules_equal_brute_force(spark):
    sets = [{"a", "b", "c"}, {"a", "b"}, {"a", "c"}, {"b", "c"}, {"a", "b", "c"}, {"d"}]
    rows = [(i, x) for i, s in enumerate(sets) for x in s]
    got = R.association_rules(spark.createDataFrame(rows, "basket int, item string"), ["basket"], "item").toPandas()

    def support(*items):
        return sum(set(items) <= s for s in sets) / len(sets)

    assert len(got)
    for _, r in got.iterrows():
        a, c = r["antecedents"].split(", "), r["consequents"].split(", ")
        assert r["support"] == pytest.approx(support(*a, *c))
        assert r["lift"] == pytest.approx(support(*a, *c) / support(*a) / support(*c))
        assert r["lift"] >= 1
    assert (got["support"] >= 0.2).all()
    assert any("," in c for c in got["consequents"])


def test_cooccurrence_equals_brute_force(spark):
    rows = [(1, 1, "x"), (1, 1, "y"), (2, 1, "z"), (1, 2, "x"), (1, 2, "y"), (3, 3, "x")]
    got = X.cooccurrence(spark.createDataFrame(rows, "userId int, movieId int, tag_clean string"), 3, 1)
    assert {(r["a"], r["b"]): r["weight"] for r in got.collect()} == {("x", "y"): 2, ("x", "z"): 1, ("y", "z"): 1}

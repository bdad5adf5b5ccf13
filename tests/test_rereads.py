"""Steps that several passes read are written once and hold only what is read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tablewright.operators import aggregates as A
from tablewright.operators import models as M
from tablewright.operators import products as PR
from tablewright.operators import recsys as K
from tablewright.operators import retrieval as V
from tablewright.operators import text as X
from tablewright.operators import topics as TO
from tablewright.plans import models as PM
from tablewright.plans import recommend as RP
from tablewright.plans.registry import load_all
from tablewright.sources.tables import stored

VECTORS, FITTED = M.vectors, M.fitted


def test_interactions_read_the_ratings_once(spark):
    rows = [(u, u * m % 7, float(m), m) for u in range(1, 9) for m in range(5)]
    ratings = stored(spark.createDataFrame(rows, "userId long, movieId long, rating double, rated_at long"), "given-ratings")
    found = K.interactions(ratings)
    assert not any("given-ratings" in f for f in found.inputFiles())
    latest = {(u, m): r for u, m, r, _ in sorted(rows, key=lambda r: r[3])}
    users, items = sorted({u for u, _ in latest}), sorted({m for _, m in latest})
    want = sorted((u, m, r, users.index(u), items.index(m)) for (u, m), r in latest.items())
    assert sorted(tuple(r) for r in found.select("userId", "movieId", "rating", "user_index", "item_index").collect()) == want


def test_popularity_lists_keep_only_seen_items_that_can_shift_a_rank(spark):
    rng = np.random.default_rng(3)
    pairs = sorted({(int(u), int(m)) for u, m in zip(rng.integers(0, 40, 400), rng.integers(0, 300, 400))})
    pairs += [(99, m) for m in range(250)]  # a long history, and below a user who has seen nothing
    train = spark.createDataFrame(pairs, "userId long, movieId long")
    users = spark.createDataFrame([(u,) for u in (*range(20), 99, 1000)], "userId long")
    found = K.popularity_topk(train, users, 4)
    counts = {m: sum(1 for _, x in pairs if x == m) for m in {m for _, m in pairs}}
    order = sorted(counts, key=lambda m: (-counts[m], m))
    want = set()
    for u in (*range(20), 99, 1000):
        mine = {m for x, m in pairs if x == u}
        want |= {(u, m, i + 1) for i, m in enumerate([m for m in order if m not in mine][:4])}
    assert {(r.userId, r.movieId, r["rank"]) for r in found.collect()} == want
    kept = spark.read.parquet(*[f for f in found.inputFiles() if "/seen-" in f])
    sizes = {u: sum(1 for x, _ in pairs if x == u) for u in range(20)}
    per_user = kept.where("userId < 20").groupBy("userId").agg(F.max("pop_rank").alias("far")).collect()
    assert all(r.far < sizes[r.userId] + 4 for r in per_user)


def test_column_pipeline_keeps_only_the_columns_that_it_reads(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(PM, "stored", lambda df, label: (kept.update({label: df.columns}), stored(df, label))[1])
    assert load_all()["ml05_column_pipeline"](spark, "/root/testdata/sf0.001").count() == 1
    assert set(kept["sales"]) == {"unit_price", "quantity", "total", "customer_type", "payment", "product_line", "rating", "split"}


def test_training_rows_are_dealt_to_partitions_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 100)
    df = stored(spark.range(1050).coalesce(1), "one-part")
    parts = M.in_parts(df).rdd.glom().map(len).collect()
    assert sum(parts) == 1050 and len(parts) == 11 and max(parts) <= 200
    assert M.in_parts(df.where("id < 90")).rdd.getNumPartitions() == df.rdd.getNumPartitions()


def test_rows_with_neighbouring_columns_send_few_sums(spark, monkeypatch):
    """One sum for each range of columns that a row is in, not one for nearly every entry."""
    counted = type("Counted", (), {"sum": staticmethod(F.count)})
    monkeypatch.setattr(PR, "Summarizer", counted)
    monkeypatch.setattr(PR, "vector_to_array", F.col)
    monkeypatch.setattr(PR, "BLOCK_ROWS", 10)
    entries = spark.createDataFrame([(u, 10 * u + i, 1.0) for u in range(20) for i in range(5)] + [(50, None, 1.0)], "r long, c long, x double")
    dense = spark.createDataFrame([(c, [1.0]) for c in range(200)], "c long, v array<double>")
    sums = {row.r: row["product"] for row in PR.sparse_times_dense(entries, dense, "r", "c", "x", "v").collect()}
    assert set(sums) == set(range(20)) and max(sums.values()) <= 2


def test_vector_search_makes_its_queries_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    vectors = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)]
    items = spark.createDataFrame(vectors, "movieId long, embedding array<double>")
    users = spark.createDataFrame(vectors[:20], "userId long, profile array<double>").mapInArrow(counted, "userId long, profile array<double>")
    found = V.block_topk(users, items, 3, "userId", "movieId", "profile", "embedding").collect()
    assert len(found) == 60 and seen.value == 20


def test_blocks_grow_so_that_copies_do_not():
    assert V.block_size(100, 100) == V.BLOCK_ROWS
    assert 200_000 / V.block_size(200_000, 200_000) < 8.1
    assert 1_200_000 / V.block_size(1_200_000, 1_200_000) < 10


def test_terms_are_dealt_once(spark):
    rows = [(1, "red fox red fox"), (1, "red hen"), (2, "red fox"), (None, "red hen blue"), (4, None), (5, "hen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bag = TO.bag_of_words(docs, "doc_id", min_docs=3)
    plan = bag._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "size(" not in plan
    want = {(1, "red", 3), (1, "hen", 1), (2, "red", 1), (None, "red", 1), (None, "hen", 1), (5, "hen", 1)}
    assert {(r.doc_id, r.term, r.n) for r in bag.collect()} == want


def test_item_neighbours_send_a_history_to_few_ranges(spark, monkeypatch):
    """Histories whose items lie near each other meet the blocks of these items only; a repeated entry counts twice, one without a feature only in the length."""
    rows = [(u, 100 * (u // 10) + (u * 3 + j) % 20, 1.0 + (u + j) % 4) for u in range(80) for j in range(12)]
    rows += [(5, 7, 2.0), (None, 7, 2.0), (6, None, 2.0)]
    data = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    sides, kind = [], type(data.groupBy("userId"))
    plain = kind.cogroup
    monkeypatch.setattr(kind, "cogroup", lambda a, b: (sides.append(b._df), plain(a, b))[1])
    got = {(r.movieId, r.neighbour): r.sim for r in PR.nearest_rows(data, "movieId", "userId", "rating", 500).collect()}
    # Eight blocks at least, of which a history spans one or two.
    assert sides[0].count() <= 3 * 80
    held = [(u, i, x) for u, i, x in rows if u is not None and i is not None]
    size = {i: np.sqrt(sum(x * x for _, j, x in rows if j == i)) for _, i, _ in held}
    want = {}
    for u, i, x in held:
        for v, j, y in held:
            if u == v and i != j:
                want[i, j] = want.get((i, j), 0.0) + x / size[i] * y / size[j]
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_predictions_do_not_write_the_neighbours(spark, monkeypatch):
    written = []
    monkeypatch.setattr(RP, "stored", lambda df, label: (written.append(label), stored(df, label))[1])
    assert load_all()["rc04_item_knn_predictions"](spark, "/root/testdata/sf0.001").count() > 0
    assert "item-neighbours" not in written


def test_search_sends_postings_not_pairs(spark, monkeypatch):
    """Every query meets every document in common words; what is dealt is a posting or a query token per cell, and k per query leave it."""
    docs = [(i, f"the of w{i % 7} w{i % 11}") for i in range(300)] + [(None, "the w1"), (300, None), (7, "the zz")]
    asked = [(i, f"the of w{i}") for i in range(30)] + [(None, "the")]
    documents, queries = spark.createDataFrame(docs, "d long, text string"), spark.createDataFrame(asked, "q long, text string")
    dealt, kind = [], type(documents.groupBy("d"))
    plain = kind.cogroup
    monkeypatch.setattr(kind, "cogroup", lambda a, b: (dealt.append((a._df, b._df)), plain(a, b))[1])
    found = X.search(queries, documents, 3, "q", "d").collect()
    assert len(found) == 30 * 3 and all(r.q is not None and r.d is not None for r in found)
    (left, right), = dealt
    assert left.count() <= 4 * 302 and right.count() <= 3 * 30 * 8


def test_customer_points_hold_only_the_measures(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(PM, "stored", lambda df, label: (kept.update({label: df.columns}), stored(df, label))[1])
    assert load_all()["ag12_cluster_profile"](spark, "/root/testdata/sf0.001").count() == 4
    assert kept["rfm"] == ["recency", "frequency", "monetary"]
    rows = [(1, "2020-01-05", 2.0, 5.0), (1, "2020-01-02", 1.0, 4.0), (2, "2020-01-01", 1.0, 1.0), (None, "2020-01-09", 1.0, 1.0)]
    sales = spark.createDataFrame(rows, "invoice_id long, d string, quantity double, total double").withColumn("ts", F.to_timestamp("d"))
    got = {tuple(r) for r in A.rfm_measures(sales).select("invoice_id", "recency", "frequency", "monetary").collect()}
    assert got == {(1, 5, 3.0, 9.0), (2, 9, 1.0, 1.0)}


def test_clustering_reads_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 100)
    rows = stored(spark.range(600).selectExpr("cast(id % 4 * 100 + id / 600 as double) as x").coalesce(1), "points")
    dealt = []
    monkeypatch.setattr(M, "vectors", lambda df, columns: (dealt.append(df.rdd.getNumPartitions()), VECTORS(df, columns))[1])
    assert M.kmeans(rows, ["x"], 4).groupBy("cluster").count().count() == 4
    assert M.elbow(rows, ["x"], range(2, 4)).count() == 2
    assert M.kmeans_by_silhouette(rows, ["x"], range(3, 5))[0].count() == 600
    assert dealt == [6, 6, 6]


def test_random_search_fits_each_draw_once(spark, monkeypatch):
    rows = spark.range(200).selectExpr("cast(id as double) as x", "cast(id % 7 as double) as y", "'unused' as name")
    gbt, fits, fit = M.boosted("y", 2, 2), [], type(M.boosted("y")).fit
    monkeypatch.setattr(type(gbt), "fit", lambda self, df, draw=None: (fits.append(df.columns), fit(self, df, draw))[1])
    found = M.random_search(gbt, {gbt.maxDepth: (2, 4), gbt.stepSize: (0.05, 0.3)}, 3, M.vectors(rows, ["x"]), "y").collect()
    assert fits == [["features", "y"]] * 3 and len({r.setting for r in found}) == 3 and all(r.mae > 0 for r in found)


def test_boosted_links_and_cleaned_rows_hold_only_what_is_read(spark, monkeypatch):
    fitted, kept = [], {}
    monkeypatch.setattr(M, "fitted", lambda e, df: (fitted.append(df.columns), FITTED(e, df))[1])
    monkeypatch.setattr(PM, "stored", lambda df, label: (kept.update({label: df.columns}), stored(df, label))[1])
    assert load_all()["ml08_boosted"](spark, "/root/testdata/sf0.001").count() == 1
    assert fitted == [["features", "q_factor", "is_val"]]
    assert load_all()["mv08_cleaning_strategies"](spark, "/root/testdata/sf0.001").count() == 3
    assert all(len(kept[f"clean-{n}"]) == 6 for n in ("drop", "policy", "blind"))

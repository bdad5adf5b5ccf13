"""Small frames with hand-computed results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.sources import tables
from tablewright.operators import aggregates as A
from tablewright.operators import columns as C
from tablewright.operators import equity as Q
from tablewright.operators import geo as G
from tablewright.operators import metrics as E
from tablewright.operators import missing as M
from tablewright.operators import windows as W


def values(df, column, order):
    return [r[column] for r in df.orderBy(order).collect()]


def test_bounds_keep_two_of_three(spark):
    df = spark.createDataFrame([(4.08, 48.25), (4.06, 48.29), (200.0, 48.0), (None, 48.0)], "x double, y double")
    assert C.in_bounds(df, {"x": (-5, 10), "y": (41, 52)}).count() == 2


def test_postcodes(spark):
    df = spark.createDataFrame([(1, "10000.0"), (2, "10450"), (3, None), (4, "77.0"), (5, "123456"), (6, "x")], "i int, c string")
    assert values(df.select("i", C.postcode("c").alias("p")), "p", "i") == ["10000", "10450", None, "00077", "123456", None]


def test_lag_flag_counts_missing(spark):
    df = spark.createDataFrame([(1, "deploye"), (2, "cible"), (3, "deploye"), (4, None)], "i int, imb_etat string")
    assert values(C.with_lag_flag(df), "is_lagging", "i") == [0, 1, 0, 1]


def test_rare_category_becomes_null(spark):
    df = spark.createDataFrame([(1, "individuel"), (2, "weird"), (3, "entre 2 et 11")], "i int, c string")
    assert values(C.members_or_null(df, "c", C.BUILDING_CATEGORIES), "c", "i") == ["individuel", None, "entre 2 et 11"]


@pytest.fixture(scope="module")
def towns(spark):
    rows = [("b%d" % i, "10001" if i < 4 else "10002", "one" if i < 4 else "two", pm, state, cat) for i, (pm, state, cat) in enumerate([
        ("P1", "deploye", "individuel"), ("P1", "deploye", "individuel"), ("P2", "deploye", "entre 2 et 11"), ("P2", "deploye", "individuel"),
        ("P3", "deploye", "entre 2 et 11"), ("P3", "cible", "individuel"), ("P3", "cible", "individuel"), ("P3", "cible", "entre 2 et 11"),
    ])]
    return spark.createDataFrame(rows, "imb_id string, code_insee string, nom_com string, pm_ref string, imb_etat string, catg_loc_imb string")


def test_equity_of_two_communes(towns):
    first, second = Q.commune_equity(towns).orderBy("code_insee").collect()
    assert (first["coverage"], second["coverage"]) == (1.0, 0.25)
    assert second["coll_lag"] == 0.5
    assert first["equity_index"] > second["equity_index"]
    assert 0 <= second["equity_index"] <= first["equity_index"] <= 1


def test_equal_weights_give_the_row_mean(towns):
    w = {"coverage": 1 / 3, "pm_load": 1 / 3, "coll_lag": 1 / 3}
    for r in Q.commune_equity(towns, w).collect():
        assert r["equity_index"] == pytest.approx((r["coverage"] + r["pm_load"] + r["coll_lag"]) / 3)


@pytest.fixture(scope="module")
def buildings(spark):
    rows = [
        ("a", "P1", "10001", None, "individuel"), ("b", "P1", "10001", "OPB", "individuel"), ("c", "P2", "10001", "OPC", "individuel"),
        ("d", "P2", "10002", "OPB", "entre 36 et 99"), ("e", "P2", "10002", "OPB", "entre 2 et 11"), ("f", "P3", "10002", "OPB", "individuel"),
    ]
    df = spark.createDataFrame(rows, "imb_id string, pm_ref string, code_insee string, code_l331 string, catg_loc_imb string")
    return C.building_flags(df.select("*", F.lit(None).cast("string").alias("batiment"), F.lit("1").alias("code_poste"), F.lit("7").alias("num_voie")))


def test_point_shares(buildings):
    shares = {r["pm_ref"]: r["pm_share_individuel"] for r in A.pm_features(buildings).collect()}
    assert shares["P1"] == 1.0
    assert shares["P2"] == pytest.approx(1 / 3)


def test_buildings_per_point(buildings):
    load = {r["code_insee"]: r["com_buildings_per_pm"] for r in A.commune_features(buildings).collect()}
    assert load["10001"] == 1.5


def test_concentration_with_missing_operator(buildings):
    hhi = {r["code_insee"]: r["com_hhi"] for r in A.operator_concentration(buildings).collect()}
    assert hhi["10001"] == pytest.approx(1 / 3)
    assert hhi["10002"] == 1.0


def test_no_feature_leaks_the_target():
    assert not [c for c in A.BUILDING_FEATURES if "lagging" in c]


def test_crs_by_range(spark):
    degrees = spark.createDataFrame([(4.0, 48.0), (4.1, 48.5)], "x double, y double")
    metres = spark.createDataFrame([(700000.0, 6800000.0), (720000.0, 6810000.0)], "x double, y double")
    assert degrees.select(G.crs(degrees)).first()[0] == "EPSG:4326"
    assert metres.select(G.crs(metres)).first()[0] == "EPSG:2154"


def test_known_projection_points(spark):
    # The origin of the projection, and a well-known tower in Paris.
    df = spark.createDataFrame([(1, 700000.0, 6600000.0), (2, 648237.0, 6862271.0)], "i int, x double, y double")
    a, b = G.with_degrees(df).orderBy("i").collect()
    assert (a["lon"], a["lat"]) == pytest.approx((3.0, 46.5), abs=1e-6)
    assert (b["lon"], b["lat"]) == pytest.approx((2.2945, 48.8583), abs=2e-3)


def test_distances(spark):
    df = spark.createDataFrame([(48.30, 4.07, 48.30, 4.07), (48.30, 4.07, 48.86, 2.35)], "a double, b double, c double, d double")
    same, far = [r[0] for r in df.select(G.haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert same == 0
    assert 130 < far < 160


def test_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "y double, p double")
    m = E.regression_metrics(df, "y", "p").first()
    assert m["rmse"] == pytest.approx(2.5 ** 0.5)
    assert m["mae"] == 1.5


def test_pairwise_products(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0)], "a double, b double, c double, d double, e double")
    assert len(C.pairwise_products(df, df.columns).columns) == 5 + 15


def test_anchor_rises(spark):
    q = spark.range(10).select((F.col("id") / 9).alias("o")).select("o", Q.anchor_q(F.col("o")).alias("q"))
    got = values(q, "q", "o")
    assert all(a < b for a, b in zip(got, got[1:]))


def test_percentile_rank_of_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 7.0), (4, 9.0)], "i int, v double")
    assert values(W.with_percentile_rank(df, "v"), "rank_pct", "i") == [0.375, 0.375, 0.75, 1.0]


def test_two_digit_and_one_digit_dates(spark):
    df = spark.createDataFrame([(1, "1/5/19"), (2, "01/05/19"), (3, "12/31/68"), (4, "n/a"), (5, "13/1/19")], "i int, d string")
    got = values(df.select("i", C.parsed_date("d").cast("string").alias("d")), "d", "i")
    assert got == ["2019-01-05", "2019-01-05", "2068-12-31", None, None]


def test_decade_floors_below_zero(spark):
    df = spark.createDataFrame([(1, -1), (2, 1999), (3, 2000)], "i int, y int")
    assert values(df.select("i", C.decade("y").alias("d")), "d", "i") == [-10, 1990, 2000]


def test_mode_prefers_the_smallest_and_falls_back(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "s string, e string")
    out = M.impute_mode(df)
    assert sorted(r["s"] for r in out.collect()) == ["a", "a", "a", "b", "b"]
    assert {r["e"] for r in out.collect()} == {"Missing"}


def test_basket_tiers_close_on_the_right(spark):
    df = spark.createDataFrame([(100.0,), (100.01,), (300.0,), (500.0,), (500.5,)], "v double")
    assert values(df.select("v", C.basket_tier("v").alias("t")), "t", "v") == ["Low", "Mid", "Mid", "High", "VeryHigh"]


def test_booleans_from_text(spark):
    df = spark.createDataFrame([(1, "True"), (2, "f"), (3, "yes"), (4, None)], "i int, s string")
    assert values(df.select("i", C.text_to_boolean("s").alias("b")), "b", "i") == [True, False, None, None]


def test_ids_above_32_bits_survive_the_reader(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n3000000000,1,4.5,0\n1,4000000000,3.0,0\n")
    rows = tables.read_ratings(spark, str(tmp_path / "ratings.csv")).collect()
    assert {(r["userId"], r["movieId"]) for r in rows} == {(3000000000, 1), (1, 4000000000)}


def test_genome_and_link_readers(spark, tmp_path):
    (tmp_path / "scores.csv").write_text("movieId,tagId,relevance\n1,40000,0.5\n")
    (tmp_path / "tags.csv").write_text("tagId,tag\n40000,space opera\n")
    (tmp_path / "links.csv").write_text("movieId,imdbId,tmdbId\n1,0114709,862\n")
    assert [tuple(r) for r in tables.read_genome_scores(spark, str(tmp_path / "scores.csv")).collect()] == [(1, 40000, 0.5)]
    assert [tuple(r) for r in tables.read_genome_tags(spark, str(tmp_path / "tags.csv")).collect()] == [(40000, "space opera")]
    assert [tuple(r) for r in tables.read_film_links(spark, str(tmp_path / "links.csv")).collect()] == [(1, "0114709", "862")]


def test_relevance_rows_hold_all_tags_and_items(spark, tables):
    from tablewright.operators.text import relevance_vectors, tag_relevance
    from tablewright.plans.registry import load_all
    from tablewright.plans.shared import tags_clean

    pairs = {(r.movieId, r.tag_clean) for r in tags_clean(tables).collect()}
    rows = load_all()["rc10_relevance_rows"].plan(tables).collect()
    assert {(r.movieId, r.tag_clean) for r in rows} == pairs and len(rows) == len(pairs)
    vectors, numbers = relevance_vectors(tag_relevance(tags_clean(tables)))
    names = [r.tag_clean for r in numbers.orderBy("tag_number").collect()]
    assert names == sorted({tag for _, tag in pairs}) and [r.tag_number for r in numbers.orderBy("tag_number").collect()] == list(range(len(names)))
    assert {(r.movieId, names[i]) for r in vectors.collect() for i in r.places} == pairs
    top = {}
    for r in rows:
        top[r.movieId] = max(top.get(r.movieId, 0.0), r.relevance)
    assert set(top.values()) == {1.0}

"""Fitted models: they beat the mean, repeat with the seed, and keep their structure."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tablewright.functions.tails import erfc, f_tail
from tablewright.operators import decomposition as D
from tablewright.operators import isotonic as I
from tablewright.operators import metrics as E
from tablewright.operators import models as M
from tablewright.operators import retail as R
from tablewright.operators import topics as P
from tablewright.session import scratch_path
from tablewright.sources import audit as AU
from tablewright.sources import files as IMG
from tablewright.sources import tables as IO
from tablewright.sources.schemas import RATINGS
from tablewright.streaming import rollup as RU
from tablewright.streaming.ingest import ingest_csv


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=600), rng.normal(size=600)
    y = 3 * a - 2 * b + 1 + rng.normal(scale=0.1, size=600)
    rows = [(i, float(p), float(q), float(r)) for i, (p, q, r) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, y double")


@pytest.fixture(scope="module")
def linear(points):
    return M.fitted(LinearRegression(labelCol="y"), M.vectors(points, ["a", "b"]))


def test_ridge_equals_its_closed_form(points):
    pdf = points.toPandas()
    x = pdf[["a", "b"]].to_numpy() - pdf[["a", "b"]].to_numpy().mean(axis=0)
    y = pdf["y"].to_numpy() - pdf["y"].mean()
    alpha = 50.0
    want = np.linalg.solve(x.T @ x + alpha * np.eye(2), x.T @ y)
    model = M.fitted(M.linear_family(points, "y", alpha)["ridge"], M.vectors(points, ["a", "b"]))
    assert list(model.coefficients) == pytest.approx(list(want), rel=1e-6)


def test_elastic_net_meets_its_optimality_conditions(points):
    pdf = points.toPandas()
    x = pdf[["a", "b"]].to_numpy() - pdf[["a", "b"]].to_numpy().mean(axis=0)
    y = pdf["y"].to_numpy() - pdf["y"].mean()
    alpha, mix = 0.4, 0.5
    for name, m in (("lasso", 1.0), ("elastic_net", mix)):
        model = M.fitted(M.linear_family(points, "y", alpha, mix)[name], M.vectors(points, ["a", "b"]))
        w = np.array(model.coefficients)
        gradient = x.T @ (y - x @ w) / 600 - alpha * (1 - m) * w
        assert gradient == pytest.approx(alpha * m * np.sign(w), abs=1e-4)


def test_models_beat_the_mean_and_repeat(points):
    data = M.vectors(points, ["a", "b"])
    for estimator in (M.forest("y", 10), M.boosted("y", 10)):
        first = M.compare({"m": M.fitted(estimator, data)}, data, "y").first()
        again = M.compare({"m": M.fitted(estimator, data)}, data, "y").first()
        assert first["r2"] > 0.7
        assert first["mae"] == pytest.approx(again["mae"])


def test_attributions_sum_to_the_prediction(points, linear):
    data = M.vectors(points, ["a", "b"])
    parts = M.linear_attributions(linear, data, ["a", "b"], ["id"])
    predicted = linear.transform(data).select("id", "prediction")
    joined = parts.join(predicted, "id").withColumn("left", F.col("prediction") - F.col("attr_a") - F.col("attr_b"))
    spread = joined.agg(F.max("left") - F.min("left")).first()[0]
    assert spread == pytest.approx(0, abs=1e-9)


def test_permutation_ranks_the_stronger_feature_first(points, linear):
    rows = M.permutation_importance(linear, points, "id", ["a", "b"], "y", repeats=2).collect()
    got = {r["feature"]: r["importance"] for r in rows}
    assert got["a"] > got["b"] > 0


def test_permutation_runs_small_jobs(points, linear, monkeypatch):
    """One shuffle of all features per repeat, and a result that no longer holds the plans of all repeats."""
    calls, shuffled = [], M.permuted_columns
    monkeypatch.setattr(M, "permuted_columns", lambda *a: (calls.append(a), shuffled(*a))[1])
    got = M.permutation_importance(linear, points, "id", ["a", "b"], "y", repeats=3)
    assert len(calls) == 3
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 5000
    alone = lambda df: linear.transform(M.vectors(df, ["a", "b"])).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    want = {f: np.mean([alone(M.permuted(points, "id", f, M.SEED + 10 * r)) for r in range(3)]) - alone(points) for f in ("a", "b")}
    assert {r.feature: r.importance for r in got.collect()} == pytest.approx(want)


def test_permuting_keeps_the_values(points):
    shuffled = M.permuted(points, "id", "a", 1).toPandas()
    original = points.toPandas()
    assert sorted(shuffled["a"]) == pytest.approx(sorted(original["a"]))
    assert not np.allclose(shuffled.sort_values("id")["a"], original.sort_values("id")["a"])


def test_partial_dependence_of_a_line(points, linear):
    rows = M.partial_dependence(linear, points, ["a", "b"], "a", [0.0, 1.0, 2.0]).orderBy("value").collect()
    steps = np.diff([r["mean_prediction"] for r in rows])
    assert steps == pytest.approx([linear.coefficients[0]] * 2)


def test_stacking_uses_validation_rows(points):
    data = M.vectors(points, ["a", "b"])
    parts = [data.where(F.pmod("id", F.lit(3)) == i) for i in range(3)]
    base = {"linear": M.fitted(LinearRegression(labelCol="y"), parts[0]), "forest": M.fitted(M.forest("y", 5), parts[0])}
    out = M.stack(base, parts[1], parts[2], "id", "y")
    assert E.regression_metrics(out, "y", "prediction").first()["r2"] > 0.95


def test_calibration_is_monotone(spark):
    rng = np.random.default_rng(6)
    p = rng.random(500)
    rows = [(i, float(s), int(rng.random() < s * s), i % 3) for i, s in enumerate(p)]
    df = spark.createDataFrame(rows, "i int, p double, y int, fold int")
    got = M.calibrate(df, "y", "p", "fold").orderBy("p").toPandas()["calibrated"]
    assert (np.diff(got) >= -1e-12).all()
    assert got.between(0, 1).all()


def rising_fit(x, y, w):
    """Largest, over beginnings not after a score, of the least mean up to an end not before it."""
    xs = np.unique(x)
    sw = np.array([w[x == v].sum() for v in xs])
    sy = np.array([(w * y)[x == v].sum() for v in xs])
    cw, cy = np.r_[0, np.cumsum(sw)], np.r_[0, np.cumsum(sy)]
    mean = (cy[None, 1:] - cy[:-1, None]) / np.where(cw[None, 1:] > cw[:-1, None], cw[None, 1:] - cw[:-1, None], np.nan)
    return xs, np.array([max(np.nanmin(mean[i, j:]) for i in range(j + 1)) for j in range(len(xs))])


@pytest.mark.parametrize("shape", ["noise", "falling", "late low", "rising", "ties"])
@pytest.mark.parametrize("most", [200_000, 1])
def test_isotonic_ranges_equal_the_whole_fit(spark, monkeypatch, shape, most):
    monkeypatch.setattr(I, "GROUP_BLOCKS", most)
    rng = np.random.default_rng(3)
    x = np.round(rng.random(300), 1 if shape == "ties" else 3)
    y = {"noise": (rng.random(300) < x).astype(float), "falling": -x, "rising": x * x, "ties": rng.random(300),
         "late low": np.where(x > 0.95, -50.0, x)}[shape]
    w = rng.integers(1, 4, 300).astype(float)
    df = spark.createDataFrame([*zip(x.tolist(), y.tolist(), w.tolist()), (None, 1.0, 1.0), (0.5, None, 1.0)], "p double, y double, w double")
    steps = I.isotonic_steps(df, "y", "p", "w")
    xs, want = rising_fit(x, y, w)
    asked = np.r_[xs, (xs[:-1] + xs[1:]) / 2, -1.0, 2.0]
    frame = spark.createDataFrame([(float(v),) for v in asked] + [(None,)], "p double")
    got = {r.p: r.v for r in I.interpolated(frame, "p", steps, "v").collect()}
    assert got.pop(None) is None
    for v, expected in zip(asked, np.interp(asked, xs, want), strict=True):
        assert got[v] == pytest.approx(expected, abs=1e-9)
    values = [r.value for r in steps.orderBy("low").collect()]
    assert all(a < b for a, b in zip(values, values[1:], strict=False))


def test_isotonic_of_nothing(spark):
    none = spark.createDataFrame([], "p double, y double")
    assert I.isotonic_steps(none, "y", "p").count() == 0


def test_decomposition_equals_the_dense_one(spark):
    rng = np.random.default_rng(14)
    left, right = np.linalg.qr(rng.normal(size=(200, 30)))[0], np.linalg.qr(rng.normal(size=(100, 30)))[0]
    a = left @ np.diag(10 * 0.8 ** np.arange(30)) @ right.T
    rows = [(10 * i, 7 * j, float(a[i, j])) for i in range(200) for j in range(100)]
    users, items, values = D.truncated_decomposition(spark.createDataFrame(rows, "u long, i long, x double"), "u", "i", "x", 6, tolerance=1e-9)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    assert values == pytest.approx(list(s[:6]), rel=1e-6)
    mine_u = np.array([r.vector for r in users.orderBy("u").collect()])
    mine_v = np.array([r.vector for r in items.orderBy("i").collect()])
    assert mine_u.shape == (200, 6) and mine_v.shape == (100, 6)
    assert mine_u @ np.diag(values) @ mine_v.T == pytest.approx(u[:, :6] @ np.diag(s[:6]) @ vt[:6], abs=1e-5)
    assert mine_v.T @ mine_v == pytest.approx(np.eye(6), abs=1e-8)


def test_decomposition_of_small_rank(spark):
    rows = [(u, i, float((u + 1) * (i - 2))) for u in range(12) for i in range(5)]
    _, items, values = D.truncated_decomposition(spark.createDataFrame(rows, "u long, i long, x double"), "u", "i", "x", 3)
    dense = np.array([[x for u2, _, x in rows if u2 == u] for u in range(12)])
    assert values == pytest.approx([np.linalg.norm(dense)]) and len(items.first()["vector"]) == 1
    zero = spark.createDataFrame([(1, 1, 0.0)], "u long, i long, x double")
    assert D.truncated_decomposition(zero, "u", "i", "x", 3)[2] == []


def test_one_hot_ignores_unknown(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    new = spark.createDataFrame([("b",), ("zzz",)], "c string")
    out = Pipeline(stages=M.one_hot_stages(["c"])).fit(train).transform(new).select("c", vector_to_array("c_hot").alias("v"))
    assert {r["c"]: r["v"] for r in out.collect()} == {"b": [0.0, 1.0, 0.0], "zzz": [0.0, 0.0, 0.0]}


def test_silhouette_finds_the_groups(spark):
    rng = np.random.default_rng(8)
    rows = [(float(c * 10 + rng.normal(scale=0.2)), float(c % 2 * 10 + rng.normal(scale=0.2))) for c in range(4) for _ in range(40)]
    assigned, table = M.kmeans_by_silhouette(spark.createDataFrame(rows, "x double, y double"), ["x", "y"])
    assert table.orderBy(F.desc("silhouette")).first()["k"] == 4
    assert assigned.select("cluster").distinct().count() == 4


def test_components_are_centred_and_ordered(tables):
    pc = M.project(tables.embeddings, "embedding", 2).agg(
        F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"), F.variance("pc1").alias("v1"), F.variance("pc2").alias("v2")).first()
    assert (pc["m1"], pc["m2"]) == pytest.approx((0, 0), abs=1e-9)
    assert pc["v1"] >= pc["v2"] > 0


def test_factors_rank_unseen_items(spark):
    rows = [(u, m, 5.0) for u in range(12) for m in range(10) if m % 2 == u % 2 and (u + m) % 5]
    train = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    lists = M.factor_topk(train, M.implicit_factors(train, 4, 8), 1)
    assert lists.join(train, ["userId", "movieId"], "left_semi").count() == 0
    hits = lists.where(F.pmod("movieId", F.lit(2)) == F.pmod("userId", F.lit(2))).count()
    assert hits >= 10


def test_factor_rounds_leave_no_lineage(spark, monkeypatch):
    """Every round ends in a checkpoint, after which the shuffle files of the rounds before it may go."""
    made, als = [], M.ALS
    monkeypatch.setattr(M, "ALS", lambda **given: (made.append(als(**given)), made[-1])[1])
    rows = [(u, i, 1.0) for u in range(12) for i in range(8) if (u + i) % 3]
    M.factor_model(spark.createDataFrame(rows, "userId long, movieId long, rating double"), 2, 2, 0.1, True)
    assert [a.getCheckpointInterval() for a in made] == [1]


def test_autoregression_equals_least_squares(spark):
    rng = np.random.default_rng(5)
    held = {"line": np.arange(56.0), "level": np.full(20, 3.0), "noise": rng.normal(size=80).cumsum(), "swing": np.tile([0.0, 1.0], 15), "six": rng.normal(size=6)}
    held |= {"five": rng.normal(size=5), "one": np.array([4.0])}
    rows = [(e, f"2024-{1 + d // 28:02d}-{1 + d % 28:02d}", float(v)) for e, y in held.items() for d, v in enumerate(y)]
    s = spark.createDataFrame(rows, "entity string, d string, y double").select("entity", F.to_date("d").alias("ds"), "y")
    got = {}
    for r in R.autoregressive_forecast(s, ["entity"], 4).orderBy("ds").collect():
        got.setdefault(r.entity, []).append((r.yhat, r.status))
    for e, y in held.items():
        d = np.diff(y)
        if len(d) < 5:
            assert got[e] == [(None, "too_short")] * 4
            continue
        beta = np.linalg.lstsq(np.column_stack([np.ones(len(d) - 2), d[1:-1], d[:-2]]), d[2:], rcond=None)[0]
        level, steps, want = y[-1], list(d), []
        for _ in range(4):
            steps.append(beta[0] + beta[1] * steps[-1] + beta[2] * steps[-2])
            level += steps[-1]
            want.append(level)
        assert [v for v, _ in got[e]] == pytest.approx(want, abs=1e-6) and {x for _, x in got[e]} == {"fitted"}


def test_champion_is_the_forecast_shown(tables):
    from tablewright.operators.aggregates import daily_series

    scores, forecast = R.champion_forecast(daily_series(tables.transactions, "product_line", "ts", "total"), "product_line", 5)
    winners = {r["product_line"]: r["winner"] for r in scores.collect()}
    shown = {(r["product_line"], r["winner"]) for r in forecast.collect()}
    assert shown == set(winners.items())


def test_topics_cover_every_document(tables):
    dominant, table = P.topics(tables.documents.select("doc_id", "text"), "doc_id", 3, 2)
    placed = dominant.where("topic between 0 and 2 and share > 0").count()
    assert table.agg(F.sum("size")).first()[0] == placed
    assert placed + dominant.where("topic = -1").count() == tables.documents.count()


def test_tail_functions(spark):
    # F(2.5; 3, 20) leaves 0.0888; F(4.35; 1, 20) about 0.05.
    df = spark.createDataFrame([(2.5, 3.0, 20.0), (4.3512, 1.0, 20.0)], "f double, a double, b double")
    got = [r[0] for r in df.select(f_tail("f", "a", "b")).collect()]
    assert got == pytest.approx([0.0888, 0.05], abs=2e-4)
    x = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (2.0,)], "x double")
    assert [r[0] for r in x.select(erfc(F.col("x"))).collect()] == pytest.approx([1.0, 0.157299, 1.842701, 0.004678], abs=1e-6)


def test_images_of_several_shapes(spark, tmp_path):
    wide = spark.createDataFrame([("train/NORMAL/a.png", [0.5] * 12)], "path string, v array<double>")
    tall = spark.createDataFrame([("test/PNEUMONIA/x_virus_b.png", [-0.5] * 12)], "path string, v array<double>")
    IMG.write_vector_images(wide, str(tmp_path), "path", "v", 4)
    IMG.write_vector_images(tall, str(tmp_path), "path", "v", 3)
    images = IMG.path_labels(IMG.read_images(spark, str(tmp_path)))
    got = {r["label"]: (r["width"], r["height"], r["subtype"], r["m"]) for r in images.select(
        "label", "width", "height", "subtype", IMG.mean_intensity("data").alias("m")).collect()}
    assert got == {"NORMAL": (4, 3, "normal", 255.0), "PNEUMONIA": (3, 4, "virus", 0.0)}


def test_ingest_reads_only_new_files(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = spark.createDataFrame([(1, 2, 4.0, 86400)], RATINGS)
    first.write.mode("append").csv(source, header=True)
    ingest_csv(spark, source, RATINGS, target, IO.with_moment, "year", progress)
    spark.createDataFrame([(3, 4, 5.0, 86400 * 400)], RATINGS).write.mode("append").csv(source, header=True)
    ingest_csv(spark, source, RATINGS, target, IO.with_moment, "year", progress)
    got = spark.read.parquet(target)
    assert sorted((r["userId"], r["year"]) for r in got.collect()) == [(1, 1970), (3, 1971)]


def test_audit_takes_the_narrowest_type(spark, tmp_path):
    lines = ["id , code,x,flag,day,at,mixed,none", '1,007,1,true,2024-01-05,2024-01-05 10:11:12,1,', '-20,012,2.5,FALSE,2024-02-29,2024-03-01T00:00:00Z,x,', '3,,1e3,,,2024-01-01,2,']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "a.csv")
    types = AU.audited_types(spark, path)
    assert types == {"id ": "bigint", " code": "string", "x": "double", "flag": "boolean", "day": "date", "at": "timestamp", "mixed": "string", "none": "string"}
    counts = {r["column"]: r for r in AU.audit(AU.read_text_columns(spark, path)).collect()}
    assert counts["mixed"]["not_bigint"] == 1 and counts["mixed"]["n_values"] == 3 and counts["none"]["n_values"] == 0
    rows = IO.read_trimmed_header(spark, path).orderBy("id").collect()
    assert [r["code"] for r in rows] == ["012", "007", None] and [r["x"] for r in rows] == [2.5, 1.0, 1000.0]
    assert str(rows[0]["day"]) == "2024-02-29" and rows[2]["flag"] is None
    wrong = AU.read_declared(spark, path, types | {"mixed": "bigint"})
    with pytest.raises(Exception, match="(?i)malformed"):
        wrong.collect()


def test_rollup_of_parts_in_any_order(spark, tmp_path):
    schema = "ts timestamp, who long, kind string, v double"
    rng = np.random.default_rng(2)
    rows = [(f"2024-01-{1 + int(rng.integers(0, 9)):02d} 10:00:00", int(rng.integers(0, 20)), f"k{int(rng.integers(0, 3))}", float(rng.integers(0, 50)) / 4) for _ in range(300)]
    events = spark.createDataFrame(rows, "t string, who long, kind string, v double").select(F.to_timestamp("t").alias("ts"), "who", "kind", "v")
    names = ("ts", "kind", "v", "who")
    source, state, progress = (str(tmp_path / n) for n in ("in", "state", "progress"))
    fields = spark.createDataFrame([], schema).schema

    def state_rows(folder):
        return sorted((str(r.day), r["item"], r.n, round(r.mean_value, 9), round(r.std_value, 6), r.people, r["first"], r["last"]) for r in RU.rollup(spark, folder).collect())

    parts = [events.where(F.pmod(F.xxhash64("who", "v"), F.lit(3)) == i) for i in (2, 0, 1)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        RU.add_events(spark, source, fields, state, progress, *names)
    RU.add_events(spark, source, fields, state, progress, *names)  # nothing new
    whole = str(tmp_path / "whole")
    RU.write_part(events, whole, "all", *names)
    assert state_rows(state) == state_rows(whole)
    # A batch that is run again after a crash replaces its part.
    RU.write_part(parts[1], state, f"{1:012d}", *names)
    assert state_rows(state) == state_rows(whole)
    closed = RU.close_days(spark, state, str(tmp_path / "closed"))
    assert state_rows(closed) == state_rows(whole)
    # An event for a closed day still counts.
    late = spark.createDataFrame([("2024-01-01 09:00:00", 99, "k0", 1.0)], "t string, who long, kind string, v double").select(F.to_timestamp("t").alias("ts"), "who", "kind", "v")
    RU.write_part(late, closed, "late", *names)
    RU.write_part(events.unionByName(late), whole, "all", *names)
    assert state_rows(closed) == state_rows(whole)


def test_partition_pruning_and_pushdown(spark, tables):
    path = IO.save_parquet(tables.ratings.withColumn("year", F.year("rated_at")), scratch_path(spark, "pruned"), partition_by="year")
    plan = spark.read.parquet(path).where("year = 1998 and rating > 3").select("userId")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThan(rating" in plan
    assert "ReadSchema: struct<userId:bigint,rating:double>" in plan

"""Model training, search and explanation with pyspark.ml and column expressions."""

from __future__ import annotations

import math
import random
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.ladders import ordered_numbers, split_row_number, with_hash_piece
from tablewright.functions.scalars import hash_bucket, ratio
from tablewright.operators.decomposition import truncated_decomposition
from tablewright.operators.isotonic import interpolated, isotonic_steps
from tablewright.operators.metrics import decisions, regression_metrics
from tablewright.operators.recsys import contiguous_ids, mean_predictions, vector_topk
from tablewright.sources.tables import stored

SEED = 42
#: Rows of one partition of an estimator's input: what a task reads again in every pass.
PART_ROWS = 1 << 17

# ---- preparation


def standardise(df: DataFrame, columns: list[str], fit_on: str | Column | None = None) -> DataFrame:
    """(x - mean) / population deviation, both taken from the rows of `fit_on` (a condition)."""
    base = df if fit_on is None else df.where(fit_on)
    moments = base.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("_m"))
    wide = df.withColumn("_m", moments.scalar())

    def scaled(c: str) -> Column:
        centred = F.col(c) - F.col("_m")[c]["m"]
        return F.coalesce(ratio(centred, F.col("_m")[c]["s"]), centred)

    return wide.withColumns({c: scaled(c) for c in columns}).drop("_m")


def log_standardise(df: DataFrame, log_columns: list[str], columns: list[str]) -> DataFrame:
    logged = df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in log_columns})
    return standardise(logged, columns)


def label_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(column, value, code)`: alphabetical code of every distinct value, numbered range by range."""
    values = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    numbered = ordered_numbers(values, ["column", "value"], "_n")
    first = numbered.groupBy("column").agg(F.min("_n").alias("_first"))
    return numbered.join(first, "column").select("column", "value", (F.col("_n") - F.col("_first")).cast("int").alias("code"))


def label_encode(df: DataFrame, columns: list[str], codes: DataFrame | None = None) -> DataFrame:
    """Replace each string column by its code; values unknown to `codes` become null."""
    codes = codes if codes is not None else label_codes(df, columns)
    for c in columns:
        one = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias(f"{c}_code"))
        df = df.join(one, c, "left")
    return df


def one_hot_stages(columns: list[str]) -> list:
    """Index and encode; a value not seen in training gets the last slot of the index."""
    index = StringIndexer(
        inputCols=columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    # The unknown slot is the last index, which dropLast leaves as the all-zero vector.
    encode = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_hot" for c in columns], dropLast=True)
    return [index, encode]


def column_pipeline(numeric: list[str], categorical: list[str], estimator: Estimator) -> Pipeline:
    """Numeric and one-hot categorical columns into one vector, then the estimator."""
    stages = one_hot_stages(categorical) if categorical else []
    inputs = [*numeric, *[f"{c}_hot" for c in categorical]]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features"), estimator])


def vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def fitted(estimator: Estimator, train: DataFrame) -> Model:
    """Fit with the training rows kept (memory, then disk) while the estimator passes over them."""
    kept = train.persist()
    try:
        return estimator.fit(kept)
    finally:
        kept.unpersist()


def in_parts(df: DataFrame) -> DataFrame:
    """Rows dealt to so many partitions that none holds many more than `PART_ROWS`; few rows stay where they are."""
    n = math.ceil(df.count() / PART_ROWS)
    return df.repartition(n) if n > df.rdd.getNumPartitions() else df


# ---- regression


def linear_family(train: DataFrame, label: str, alpha: float, mix: float = 0.5) -> dict[str, LinearRegression]:
    """Linear, ridge, lasso and elastic net in the usual textbook penalties.

    Ridge minimises the squared error plus alpha |w|^2; lasso and elastic net half the mean squared
    error plus alpha (mix |w|_1 + (1 - mix) / 2 |w|^2). The estimator divides its quadratic penalty
    by the deviation of the label, which is undone here.
    """
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    common = {"labelCol": label, "standardization": False}
    absolute, quadratic = alpha * mix, alpha * (1 - mix) * row["s"]
    return {
        "linear": LinearRegression(regParam=0.0, **common),
        "ridge": LinearRegression(regParam=alpha / row["n"] * row["s"], elasticNetParam=0.0, **common),
        "lasso": LinearRegression(regParam=alpha, elasticNetParam=1.0, **common),
        "elastic_net": LinearRegression(regParam=absolute + quadratic, elasticNetParam=absolute / (absolute + quadratic), **common),
    }


def forest(label: str, trees: int = 20, depth: int = 6) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, seed=SEED)


def boosted(label: str, rounds: int = 20, depth: int = 4, validation: str | None = None) -> GBTRegressor:
    """Boosted trees; with a validation flag column training stops when its error no longer falls."""
    gbt = GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=depth, seed=SEED, stepSize=0.1)
    return gbt.setValidationIndicatorCol(validation) if validation else gbt


def compare(models: dict[str, Model], test: DataFrame, label: str) -> DataFrame:
    """One metrics row per model."""
    rows = [
        regression_metrics(m.transform(test), label, "prediction").select(F.lit(name).alias("model"), "*")
        for name, m in models.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def grid_search(estimator: Estimator, grid: dict, df: DataFrame, label: str, fold: str, k: int, parallelism: int = 2):
    """Cross-validated search over given fold numbers."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, values)
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=builder.build(), evaluator=RegressionEvaluator(labelCol=label, metricName="mae"),
        numFolds=k, foldCol=fold, parallelism=parallelism, seed=SEED,
    )
    return fitted(cv, df)


def search_table(search, df: DataFrame) -> DataFrame:
    """Parameters and mean error of every setting tried."""
    return _settings(search.getEstimatorParamMaps(), search.avgMetrics, df)


def _settings(maps: list[dict], errors: list[float], df: DataFrame) -> DataFrame:
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda i: i[0].name)), float(e)) for m, e in zip(maps, errors)]
    return df.sparkSession.createDataFrame(rows, "setting string, mae double")


def random_search(estimator: Estimator, space: dict, trials: int, df: DataFrame, label: str) -> DataFrame:
    """`(setting, mae)` of seeded random draws from ranges `(low, high)` (integers stay integers), one validation split.

    One trial after the other, so that the rows of one fit are held at a time; no model is fitted again on all rows.
    """
    rng = random.Random(SEED)
    draws = []
    for _ in range(trials):
        draws.append({
            p: rng.randint(low, high) if isinstance(low, int) else rng.uniform(low, high) for p, (low, high) in space.items()
        })
    rows = df.select("features", label, F.rand(SEED).alias("_draw"))
    train = rows.where(~(F.col("_draw") >= 0.8)).drop("_draw").persist()
    validation = rows.where(F.col("_draw") >= 0.8).drop("_draw")
    judge = RegressionEvaluator(labelCol=label, metricName="mae")
    try:
        errors = [judge.evaluate(estimator.fit(train, draw).transform(validation)) for draw in draws]
    finally:
        train.unpersist()
    return _settings(draws, errors, df)


def stack(models: dict[str, Model], validation: DataFrame, test: DataFrame, key: str, label: str) -> DataFrame:
    """Linear combination of base predictions, fitted on validation rows, applied to test rows."""
    names = list(models)

    def base(df: DataFrame) -> DataFrame:
        out = df
        for n, m in models.items():
            out = m.transform(out).withColumnRenamed("prediction", f"p_{n}")
        return vectors(out.select(key, label, *[f"p_{n}" for n in names]), [f"p_{n}" for n in names])

    meta = fitted(LinearRegression(labelCol=label, regParam=1e-6), base(validation))
    return meta.transform(base(test)).drop("features")


# ---- classification


def boosted_classifier(label: str, rounds: int = 15, depth: int = 4) -> GBTClassifier:
    return GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, seed=SEED)


def positive_probability(df: DataFrame, name: str = "score") -> DataFrame:
    return df.withColumn(name, vector_to_array("probability")[1])


def held_out_scores(estimator: Estimator, df: DataFrame, fold: str, k: int) -> DataFrame:
    """Every row with the `score` of a model fitted on the other folds."""
    parts = []
    for i in range(k):
        model = fitted(estimator, df.where(F.col(fold) != i))
        parts.append(positive_probability(model.transform(df.where(F.col(fold) == i))))
    return reduce(DataFrame.unionByName, parts)


def calibrated_scores(estimator: Estimator, train: DataFrame, y: str, fold: str, rows: DataFrame, k: int = 3) -> DataFrame:
    """`calibrated`: mean of k classifiers, each fitted outside a fold and mapped by an isotonic fit on that fold."""
    out, names = rows, [f"_c{i}" for i in range(k)]
    for i, name in enumerate(names):
        model = fitted(estimator, train.where(F.col(fold) != i))
        held = positive_probability(model.transform(train.where(F.col(fold) == i)), "_s")
        steps = isotonic_steps(held, y, "_s")
        scored = positive_probability(model.transform(out), "_s").drop("rawPrediction", "probability", "prediction")
        out = interpolated(stored(scored, "scored"), "_s", steps, name).drop("_s")
    return out.withColumn("calibrated", reduce(lambda a, b: a + b, [F.col(n) for n in names]) / k).drop(*names)


def calibrate(df: DataFrame, y: str, score: str, fold: str, k: int = 3) -> DataFrame:
    """`calibrated`: mean of k isotonic fits of given scores, each on the rows outside one fold."""
    out, names = df, [f"_c{i}" for i in range(k)]
    for i, name in enumerate(names):
        out = interpolated(out, score, isotonic_steps(df.where(F.col(fold) != i), y, score), name)
    return out.withColumn("calibrated", reduce(lambda a, b: a + b, [F.col(n) for n in names]) / k).drop(*names)


def uplift(df: DataFrame, features: list[str], treatment: str, outcome: str) -> DataFrame:
    """One model with the treatment among its inputs; effect = score treated less score untreated."""
    model = fitted(boosted_classifier(outcome), vectors(df, [*features, treatment]).select("features", outcome))

    extra = ["features", "rawPrediction", "probability", "prediction"]
    out = df.drop(treatment)
    for value, name in ((1, "p1"), (0, "p0")):
        fixed = vectors(out.withColumn(treatment, F.lit(value)), [*features, treatment])
        out = positive_probability(model.transform(fixed), name).drop(*extra, treatment)
    return out.withColumn("effect", F.col("p1") - F.col("p0"))


# ---- clustering and projection


def kmeans_by_silhouette(df: DataFrame, columns: list[str], ks: range = range(3, 7)):
    """The clustering of best silhouette (squared distance) and the table of all k."""
    data = vectors(in_parts(df), columns).persist()
    judge = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean")
    best, rows = None, []
    for k in ks:
        model = KMeans(k=k, seed=SEED, initSteps=5).fit(data)
        score = judge.evaluate(model.transform(data))
        rows.append((k, float(score), float(model.summary.trainingCost)))
        if best is None or score > best[0]:
            best = (score, model)
    table = df.sparkSession.createDataFrame(rows, "k int, silhouette double, inertia double")
    assigned = best[1].transform(data).withColumnRenamed("prediction", "cluster").drop("features")
    data.unpersist()
    return assigned, table


def elbow(df: DataFrame, columns: list[str], ks: range = range(2, 8)) -> DataFrame:
    data = vectors(in_parts(df), columns).persist()
    rows = [(k, float(KMeans(k=k, seed=SEED).fit(data).summary.trainingCost)) for k in ks]
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def kmeans(df: DataFrame, columns: list[str], k: int = 4) -> DataFrame:
    data = vectors(in_parts(df), columns)
    return fitted(KMeans(k=k, seed=SEED), data.select("features")).transform(data).withColumnRenamed("prediction", "cluster").drop("features")


def project(df: DataFrame, vector: str, k: int = 2) -> DataFrame:
    """Principal components of an array column, centred; columns pc1..pck."""
    data = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = fitted(PCA(k=k, inputCol="_v", outputCol="_pc"), data.select("_v"))
    out = model.transform(data).withColumn("_pc", vector_to_array("_pc"))
    means = out.agg(F.struct(*[F.avg(F.col("_pc")[i]).alias(f"m{i}") for i in range(k)]).alias("m"))
    out = out.withColumn("_m", means.scalar())
    return out.withColumns({f"pc{i + 1}": F.col("_pc")[i] - F.col("_m")[f"m{i}"] for i in range(k)}).drop("_v", "_pc", "_m")


# ---- factors


def _indexed(train: DataFrame, rating: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    users, items = contiguous_ids(train, "userId", "u"), contiguous_ids(train, "movieId", "i")
    data = train.join(users, "userId").join(items, "movieId").select("u", "i", F.col(rating).cast("float").alias("r"))
    return data, users, items


def factor_model(train: DataFrame, rank: int, iterations: int, reg: float, implicit: bool, rating: str = "rating"):
    """`(users, items)` with factor vectors, fitted by alternating least squares.

    A checkpoint every round ends the lineage, so that the shuffle files of earlier rounds can go.
    """
    data, users, items = _indexed(train, rating)
    als = ALS(
        userCol="u", itemCol="i", ratingCol="r", rank=rank, maxIter=iterations, regParam=reg, implicitPrefs=implicit,
        alpha=1.0, seed=SEED, coldStartStrategy="drop", checkpointInterval=1,
    )
    model = fitted(als, data)
    user_vectors = model.userFactors.select(F.col("id").alias("u"), F.col("features").alias("profile")).join(users, "u").drop("u")
    item_vectors = model.itemFactors.select(F.col("id").alias("i"), F.col("features").alias("embedding")).join(items, "i").drop("i")
    return user_vectors, item_vectors


def implicit_factors(train: DataFrame, rank: int = 64, iterations: int = 15):
    return factor_model(train, rank, iterations, 0.05, True)


def factor_topk(train: DataFrame, factors: tuple[DataFrame, DataFrame], k: int = 10) -> DataFrame:
    """Best unseen items per user by the product of their factors, exact."""
    return vector_topk(factors[0], factors[1], k, seen=train)


def residuals(train: DataFrame) -> DataFrame:
    """`(userId, movieId, residual)`: what the bias model leaves of each rating."""
    left = mean_predictions(train, train.select("userId", "movieId", "rating"))
    return left.select("userId", "movieId", (F.col("rating") - F.col("bias")).alias("residual"))


def residual_factors(train: DataFrame, rank: int = 64, iterations: int = 10) -> tuple[DataFrame, DataFrame]:
    """`(users, items)`: singular vectors of the residuals times the square roots of the singular values."""
    users, items, values = truncated_decomposition(residuals(train), "userId", "movieId", "residual", rank, iterations)

    def scaled(df: DataFrame, key: str, name: str) -> DataFrame:
        roots = F.array(*[F.lit(v**0.5) for v in values])
        return df.select(key, F.zip_with("vector", roots, lambda x, s: x * s).alias(name))

    return scaled(users, "userId", "profile"), scaled(items, "movieId", "embedding")


def residual_predictions(train: DataFrame, pairs: DataFrame, factors: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Bias plus factor product; pairs with an unknown side keep the bias."""
    from tablewright.functions.scalars import dot

    base = mean_predictions(train, pairs)
    joined = base.join(factors[0], "userId", "left").join(factors[1], "movieId", "left")
    extra = F.coalesce(dot("profile", "embedding"), F.lit(0.0))
    return joined.withColumn("prediction", F.col("bias") + extra).drop("profile", "embedding")


# ---- explanation


def importances(model: Model, features: list[str], df: DataFrame, n: int = 20) -> DataFrame:
    """Largest feature importances of a tree model."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(n)


def permuted_columns(df: DataFrame, key: str, columns: list[str], seed: int) -> DataFrame:
    """`_shuffled_` columns beside the rows: values numbered by one hash order meet keys numbered by another."""
    def numbered(frame: DataFrame, s: int) -> DataFrame:
        pieced = with_hash_piece(frame, key, s)
        return split_row_number(pieced, (), [hash_bucket(key, s), F.col(key)], "_n", "_piece")

    values = numbered(df.select(key, *columns), seed + 1).select("_n", *[F.col(c).alias(f"_shuffled_{c}") for c in columns])
    return numbered(df, seed + 2).join(values, "_n").drop("_n")


def permuted(df: DataFrame, key: str, column: str, seed: int) -> DataFrame:
    """Shuffle one column."""
    return permuted_columns(df, key, [column], seed).withColumn(column, F.col(f"_shuffled_{column}")).drop(f"_shuffled_{column}")


def permutation_importance(model: Model, df: DataFrame, key: str, features: list[str], label: str, repeats: int = 5) -> DataFrame:
    """Rise of the mean absolute error when a feature is shuffled, mean over repeats."""
    def errors(frame: DataFrame) -> dict:
        # One number per feature: small jobs, whose plans the driver can drop, instead of a union of all.
        gap = F.abs(F.col("prediction") - F.col(label))
        return {r["_f"]: r["mae"] for r in model.transform(vectors(frame, features)).groupBy("_f").agg(F.avg(gap).alias("mae")).collect()}

    base = errors(df.withColumn("_f", F.lit(""))).get("")
    rows = []
    for r in range(repeats):
        both = permuted_columns(df, key, features, SEED + 10 * r).withColumn("_f", F.explode(F.array(*[F.lit(f) for f in features])))
        chosen = both.withColumns({f: F.when(F.col("_f") == f, F.col(f"_shuffled_{f}")).otherwise(F.col(f)) for f in features})
        found = errors(chosen)
        rows += [(f, found.get(f)) for f in features]
    table = df.sparkSession.createDataFrame(rows, "feature string, mae double")
    return table.groupBy("feature").agg((F.avg("mae") - F.lit(base).cast("double")).alias("importance"))


def partial_dependence(model: Model, df: DataFrame, features: list[str], feature: str, grid: list[float]) -> DataFrame:
    """Mean prediction with one feature set to each grid value; rows meet the grid in their own task."""
    points = F.explode(F.array(*[F.lit(float(g)) for g in grid]))
    spread = df.select(*features).withColumn("_g", points).withColumn(feature, F.col("_g"))
    return model.transform(vectors(spread, features)).groupBy(F.col("_g").alias("value")).agg(F.avg("prediction").alias("mean_prediction"))


def feature_sweep(model: Model, df: DataFrame, features: list[str], feature: str, points: int = 100) -> DataFrame:
    """Prediction over the range of one feature with the others at their means."""
    row = df.agg(*[F.avg(f).alias(f) for f in features if f != feature], F.min(feature).alias("_lo"), F.max(feature).alias("_hi"))
    at = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_i") / (points - 1)
    swept = row.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(feature, at)
    return model.transform(vectors(swept, features)).select(F.col(feature).alias("value"), "prediction")


def linear_attributions(model, df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """coefficient x (value - mean) per feature; they sum to the prediction less its mean."""
    means = df.agg(F.struct(*[F.avg(f).alias(f) for f in features]).alias("m")).scalar()
    wide = df.withColumn("_m", means)
    coefficients = dict(zip(features, [float(c) for c in model.coefficients]))
    return wide.select(*keep, *[((F.col(f) - F.col("_m")[f]) * coefficients[f]).alias(f"attr_{f}") for f in features])


# ---- persistence


def save_bundle(model: PipelineModel, metrics: DataFrame, path: str) -> str:
    """Fitted pipeline and its metrics side by side."""
    model.write().overwrite().save(f"{path}/model")
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    return path


def load_bundle(df: DataFrame, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), df.sparkSession.read.parquet(f"{path}/metrics")


#: Decision threshold where none is stored.
DEFAULT_THRESHOLD = 0.5


def save_threshold(spark: SparkSession, value: float, path: str) -> str:
    """A tuned decision threshold as one JSON row."""
    spark.range(1).select(F.lit(float(value)).alias("threshold")).write.mode("overwrite").json(path)
    return path


def load_threshold(spark: SparkSession, path: str, default: float = DEFAULT_THRESHOLD) -> float:
    """The stored threshold; the default where there is no file, or none with a number."""
    try:
        row = spark.read.schema("threshold double").json(path).agg(F.max("threshold")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return default
    return default if row[0] is None else row[0]


def score_batch(model: Model, rows: DataFrame, threshold: float, score: str = "prediction") -> DataFrame:
    """Rows with the model's score and `predicted`, 1 where the score reaches the threshold."""
    return decisions(model.transform(rows), score, threshold)

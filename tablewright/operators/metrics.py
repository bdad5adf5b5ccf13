"""Evaluation: regression, classification at thresholds, curves, ranking."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.ladders import global_rank, ladder
from tablewright.functions.scalars import as_column, dot, flag, ratio, unit_vector, vector_mean
from tablewright.operators.profiling import bin_number

# ---- regression


def regression_metrics(df: DataFrame, y: str, p: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (percent, denominator at least 1e-6)."""
    e = F.col(y) - F.col(p)
    aggs = [
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - ratio(F.avg(e * e), F.var_pop(y))).alias("r2"),
        (F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(1e-6))) * 100).alias("mape"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def residuals(df: DataFrame, key: str, y: str, p: str) -> DataFrame:
    return df.select(key, y, p, (F.col(y) - F.col(p)).alias("error"))


def best_model(metrics: DataFrame, model: str, value: str) -> DataFrame:
    """The model of the smallest value, ties by name."""
    return metrics.agg(
        F.min_by(model, F.struct(value, model)).alias("champion"), F.min(value).alias(value)
    )


# ---- classification at one threshold


def decisions(df: DataFrame, score: str, threshold: float | Column = 0.5) -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn("predicted", flag(F.col(score) >= t))


def confusion(df: DataFrame, y: str, score: str, threshold: float = 0.5) -> DataFrame:
    return decisions(df, score, threshold).groupBy(F.col(y).alias("actual"), "predicted").agg(F.count(F.lit(1)).alias("n"))


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    one = F.lit(1)
    precision, recall = tp / F.greatest(tp + fp, one), tp / F.greatest(tp + fn, one)
    f1 = 2 * precision * recall / F.greatest(precision + recall, F.lit(1e-9))
    return [
        ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
    ]


def classification_metrics(df: DataFrame, y: str, score: str, threshold: float | Column = 0.5) -> DataFrame:
    d = decisions(df, score, threshold)
    hit, miss = F.col("predicted") == 1, F.col("predicted") == 0
    pos, neg = F.col(y) == 1, F.col(y) == 0
    counts = d.agg(
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & neg).alias("fp"),
        F.count_if(miss & pos).alias("fn"), F.count_if(miss & neg).alias("tn"),
    )
    return counts.select("tp", "fp", "fn", "tn", *_rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


# The threshold grid in hundredths, the recall to reach, the threshold otherwise.
GRID = (5, 95)
RECALL_TARGET = 0.95
DEFAULT_THRESHOLD = 0.5


def threshold_sweep(df: DataFrame, y: str, score: str) -> DataFrame:
    """Metrics at 91 thresholds. Rows are counted once per grid step; the sums run over the grid."""
    near = F.floor(F.col(score) * 100).cast("int")
    step = F.when(F.col(score) >= (near + 1) / 100, near + 1).when(F.col(score) < near / 100, near - 1).otherwise(near)
    step = F.least(F.greatest(step, F.lit(GRID[0] - 1)), F.lit(GRID[1]))
    counts = df.groupBy(step.alias("step")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    grid = df.sparkSession.range(GRID[0] - 1, GRID[1] + 1).select(F.col("id").cast("int").alias("step"))
    all_steps = grid.join(counts, "step", "left").na.fill(0)
    # 92 rows at most, whatever the data size.
    down = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = all_steps.select(
        "step", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(whole).alias("_p"), F.sum("neg").over(whole).alias("_n"),
    ).where(F.col("step") >= GRID[0])
    tp, fp = F.col("tp"), F.col("fp")
    return summed.select((F.col("step") / 100).alias("threshold"), *_rates(tp, fp, F.col("_p") - tp, F.col("_n") - fp))


def chosen_threshold(sweep: DataFrame) -> DataFrame:
    """Best precision among thresholds reaching the recall target, smallest on ties."""
    ok = F.col("recall") >= RECALL_TARGET
    best = F.min_by(F.when(ok, F.col("threshold")), F.when(ok, F.struct(-F.col("precision"), "threshold")))
    return sweep.agg(F.coalesce(best, F.lit(DEFAULT_THRESHOLD)).alias("threshold"))


def classification_report(df: DataFrame, y: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    cells = confusion(df, y, score, threshold)
    n = F.col("n")
    parts = []
    for c in (0, 1):
        hit = F.sum(F.when((F.col("actual") == c) & (F.col("predicted") == c), n).otherwise(0))
        predicted = F.sum(F.when(F.col("predicted") == c, n).otherwise(0))
        actual = F.sum(F.when(F.col("actual") == c, n).otherwise(0))
        p, r = F.coalesce(ratio(hit, predicted), F.lit(0.0)), F.coalesce(ratio(hit, actual), F.lit(0.0))
        parts.append(F.struct(F.lit(str(c)).alias("label"), p.alias("precision"), r.alias("recall"),
                              F.coalesce(ratio(2 * p * r, p + r), F.lit(0.0)).alias("f1"), actual.alias("support")))
    row = cells.agg(F.array(*parts).alias("c"))
    a, b = F.col("c")[0], F.col("c")[1]
    total = a["support"] + b["support"]

    def mean(name: str, weighted: bool) -> Column:
        if weighted:
            return ((a[name] * a["support"] + b[name] * b["support"]) / total).alias(name)
        return ((a[name] + b[name]) / 2).alias(name)

    extra = [
        F.struct(F.lit(label).alias("label"), *[mean(m, w) for m in ("precision", "recall", "f1")], total.alias("support"))
        for label, w in (("macro", False), ("weighted", True))
    ]
    return row.select(F.explode(F.concat("c", F.array(*extra))).alias("r")).select("r.*")


# ---- curves


def _score_steps(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives at and above each distinct score."""
    steps = ladder(
        df, score, measures={"pos": F.count_if(F.col(y) == 1), "neg": F.count_if(F.col(y) == 0)}
    )
    return steps.withColumn("tp", F.col("pos_total") - F.col("pos_before")).withColumn(
        "fp", F.col("neg_total") - F.col("neg_before"))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    s = _score_steps(df, y, score)
    return s.select(F.col(score).alias("threshold"), ratio("fp", "neg_total").alias("fpr"), ratio("tp", "pos_total").alias("tpr"))


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve with tied scores counted half."""
    s = _score_steps(df, y, score)
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return s.agg(ratio(wins, F.max("pos_total").cast("double") * F.max("neg_total")).alias("auc"))


def pr_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    s = _score_steps(df, y, score)
    return s.select(F.col(score).alias("threshold"), ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
                    ratio("tp", "pos_total").alias("recall"))


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    s = _score_steps(df, y, score)
    gain = ratio("pos", "pos_total") * ratio("tp", F.col("tp") + F.col("fp"))
    return s.agg(F.sum(gain).alias("average_precision"))


def brier(df: DataFrame, y: str, score: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(y), 2)).alias("brier"))


def reliability(df: DataFrame, y: str, score: str, bins: int = 10, min_rows: int = 20) -> DataFrame:
    b = F.greatest(F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    g = df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(y).alias("observed"))
    return g.where(F.col("n") >= min_rows)


def error_cases(df: DataFrame, key: str, y: str, score: str, threshold: float, picks: dict[str, int]) -> DataFrame:
    """Strongest true positives and the lowest-scored true and false negatives."""
    d = decisions(df, score, threshold)
    outcome = (
        F.when((F.col("predicted") == 1) & (F.col(y) == 1), "TP").when((F.col("predicted") == 0) & (F.col(y) == 0), "TN")
        .when((F.col("predicted") == 0) & (F.col(y) == 1), "FN")
    )
    order = F.when(F.col("outcome") == "TP", -F.col(score)).otherwise(F.col(score))
    w = Window.partitionBy("outcome").orderBy(order, key)
    ranked = d.withColumn("outcome", outcome).where("outcome is not null").withColumn("rank", F.row_number().over(w))
    ranked = ranked.where(F.col("rank") <= max(picks.values()))
    limit = F.coalesce(*[F.when(F.col("outcome") == o, F.lit(n)) for o, n in picks.items()], F.lit(0))
    return ranked.where(F.col("rank") <= limit).select("outcome", "rank", key, y, score)


def conformal_radius(df: DataFrame, y: str, p: str, alpha: float = 0.1) -> DataFrame:
    """The k-th smallest absolute residual, k = ceil((n + 1)(1 - alpha)) within 1..n."""
    errors = df.select(F.abs(F.col(y) - F.col(p)).alias("_e"))
    steps = ladder(errors, "_e")
    k = F.least(F.greatest(F.ceil((F.col("n_total") + 1) * F.lit(1 - alpha) - 1e-9), F.lit(1)), F.col("n_total"))
    here = (F.col("n_before") < k) & (k <= F.col("n_before") + F.col("n"))
    return steps.where(here).select(F.col("_e").alias("radius"))


def coverage(df: DataFrame, y: str, p: str, radius: Column) -> DataFrame:
    inside = F.abs(F.col(y) - F.col(p)) <= radius
    return df.agg(F.avg(flag(inside)).alias("coverage"), F.count(F.lit(1)).alias("n"))


def min_max_long(metrics: DataFrame, model: str, names: list[str]) -> DataFrame:
    """Each metric scaled to 0..1 over the models, as rows. Metric tables have one row per model."""
    long = metrics.select(model, *[F.col(c).cast("double").alias(c) for c in names]).unpivot([model], names, "metric", "value")
    w = Window.partitionBy("metric")
    low, high = F.min("value").over(w), F.max("value").over(w)
    return long.withColumn("scaled", F.coalesce(ratio(F.col("value") - low, high - low), F.lit(0.0)))


# ---- ranking


def relevant_pairs(test: DataFrame, liked: float = 3.5) -> DataFrame:
    return test.where(F.col("rating") >= liked).select("userId", "movieId")


def _ideal(k: int) -> Column:
    total, out = 0.0, []
    for i in range(1, k + 1):
        total += 1 / math.log2(i + 1)
        out.append(F.lit(total))
    return F.array(*out)


def ranking_by_user(topk: DataFrame, test: DataFrame, k: int = 10) -> DataFrame:
    """Precision, recall, NDCG, MAP and MRR at k per user with a relevant item."""
    relevant = relevant_pairs(test)
    totals = relevant.groupBy("userId").agg(F.count(F.lit(1)).alias("_rel"))
    hits = topk.where(F.col("rank") <= k).join(relevant, ["userId", "movieId"], "left_semi").select("userId", "rank")
    # At most k hits per user.
    order = Window.partitionBy("userId").orderBy("rank")
    hits = hits.withColumn("_nth", F.row_number().over(order))
    per_user = hits.groupBy("userId").agg(
        F.count(F.lit(1)).alias("_hits"), F.sum(1 / F.log2(F.col("rank") + 1.0)).alias("_dcg"),
        F.sum(F.col("_nth") / F.col("rank")).alias("_ap"), F.min("rank").alias("_first"),
    )
    joined = totals.join(per_user, "userId", "left").na.fill(0, ["_hits"]).na.fill(0.0, ["_dcg", "_ap"])
    cap = F.least(F.col("_rel"), F.lit(k)).cast("int")
    return joined.select(
        "userId", (F.col("_hits") / k).alias("precision"), (F.col("_hits") / F.col("_rel")).alias("recall"),
        (F.col("_dcg") / F.element_at(_ideal(k), cap)).alias("ndcg"), (F.col("_ap") / cap).alias("map"),
        F.coalesce(ratio(F.lit(1), "_first"), F.lit(0.0)).alias("mrr"),
    )


RANKING = ["precision", "recall", "ndcg", "map", "mrr"]


def ranking_metrics(topk: DataFrame, test: DataFrame, k: int = 10, segments: DataFrame | None = None) -> DataFrame:
    """Mean of the per-user metrics, over all users or per segment in one job."""
    users = ranking_by_user(topk, test, k)
    aggs = [*[F.avg(m).alias(m) for m in RANKING], F.count(F.lit(1)).alias("n_users")]
    if segments is None:
        return users.agg(*aggs)
    return users.join(segments.select("userId", "segment"), "userId").groupBy("segment").agg(*aggs)


def evaluated(topk: DataFrame, test: DataFrame, k: int) -> DataFrame:
    """The lists of users with a relevant item."""
    users = relevant_pairs(test).select("userId").distinct()
    return topk.where(F.col("rank") <= k).join(users, "userId", "left_semi")


def catalogue_coverage(lists: DataFrame, catalogue: DataFrame) -> DataFrame:
    n = catalogue.agg(F.count_distinct("movieId")).scalar()
    return lists.agg(ratio(F.count_distinct("movieId"), n).alias("coverage"))


def novelty(lists: DataFrame, train: DataFrame) -> DataFrame:
    """Mean over users of the mean -log2 popularity share of their list."""
    pop = train.groupBy("movieId").agg(F.count(F.lit(1)).alias("_n"))
    share = ratio("_n", train.agg(F.count(F.lit(1))).scalar())
    joined = lists.join(pop, "movieId", "left")
    bits = -F.log2(F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(1e-12)))
    return joined.groupBy("userId").agg(F.avg(bits).alias("_b")).agg(F.avg("_b").alias("novelty"))


def diversity(lists: DataFrame, items: DataFrame) -> DataFrame:
    """Mean over users of 1 - mean pairwise cosine of the list.

    The sum over pairs is (|sum of unit vectors|^2 - n) / 2, so no pair is formed.
    """
    units = items.select("movieId", unit_vector("embedding").alias("_v"))
    joined = lists.join(units, "movieId")
    sizes = joined.groupBy("userId").agg(F.count(F.lit(1)).alias("_n"))
    per_user = vector_mean(joined, ["userId"], "_v").join(sizes, "userId").where("_n > 1")
    # |sum|^2 = n^2 |mean|^2 and the squared lengths of unit vectors sum to n.
    n = F.col("_n")
    mean_cosine = (n * n * dot("profile", "profile") - n) / (n * (n - 1))
    return per_user.agg(F.avg(1 - mean_cosine).alias("diversity"))


def serendipity(lists: DataFrame, train: DataFrame, test: DataFrame, catalogue: DataFrame, k: int = 10, share: float = 0.1) -> DataFrame:
    """Relevant hits outside the most popular share of the catalogue, over k."""
    counts = train.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))
    n_items = catalogue.agg(F.count_distinct("movieId")).scalar()
    top = global_rank(counts, "n", "movieId", "pop_rank").where(
        F.col("pop_rank") <= F.greatest(F.floor(n_items * share), F.lit(1)))
    found = lists.join(relevant_pairs(test), ["userId", "movieId"], "left_semi").join(top, "movieId", "left_anti")
    hits = found.groupBy("userId").agg(F.count(F.lit(1)).alias("_h"))
    users = lists.select("userId").distinct().join(hits, "userId", "left")
    return users.agg(F.avg(F.coalesce("_h", F.lit(0)) / k).alias("serendipity"))


def residual_histogram(df: DataFrame, y: str, p: str, low: float, high: float, bins: int) -> DataFrame:
    e = as_column(y) - as_column(p)
    return df.groupBy(bin_number(e, low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))

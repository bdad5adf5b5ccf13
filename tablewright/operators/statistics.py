"""Correlations, tests and dependence measures, each from one or two aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ladders import average_rank, quantile_table, with_quantiles
from tablewright.functions.scalars import flag, ratio
from tablewright.functions.tails import f_tail
from tablewright.sources.tables import stored


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(a, b, corr)` of every pair, all pairs in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    names = F.split("pair", r"\|")
    return row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr").select(
        names[0].alias("a"), names[1].alias("b"), "corr"
    )


def target_correlation(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    row = df.agg(*[F.corr(c, target).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "corr")


def spearman(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Rank correlation with tied values sharing their mean rank.

    Equal (value, target) pairs are counted once; ranks are joined to the counted pairs.
    """
    out = []
    target_ranks = average_rank(df, target).select(F.col(target).alias("_t"), F.col("rank").alias("_rt"))
    for c in columns:
        pairs = df.groupBy(F.col(c).cast("double").alias("_c"), F.col(target).cast("double").alias("_t")).agg(
            F.count(F.lit(1)).cast("double").alias("_n"))
        ranks = average_rank(df, c).select(F.col(c).alias("_c"), F.col("rank").alias("_rc"))
        joined = pairs.join(ranks, "_c").join(target_ranks, "_t")
        n, x, y = F.sum("_n"), F.col("_rc"), F.col("_rt")
        sums = joined.agg(
            n.alias("n"), F.sum(F.col("_n") * x).alias("x"), F.sum(F.col("_n") * y).alias("y"),
            F.sum(F.col("_n") * x * x).alias("xx"), F.sum(F.col("_n") * y * y).alias("yy"), F.sum(F.col("_n") * x * y).alias("xy"),
        )
        s = F.col
        covariance = s("xy") - s("x") * s("y") / s("n")
        spread = F.sqrt((s("xx") - s("x") * s("x") / s("n")) * (s("yy") - s("y") * s("y") / s("n")))
        out.append(sums.select(F.lit(c).alias("column"), ratio(covariance, spread).alias("rho")))
    return reduce(DataFrame.unionByName, out)


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F statistic with its degrees of freedom, from group counts, means and variances."""
    g = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    n, k = F.sum("n"), F.count(F.lit(1))
    grand = F.sum(F.col("n") * F.col("m")) / n
    between = F.sum(F.col("n") * F.col("m") * F.col("m")) - n * grand * grand
    within = F.sum(F.col("n") * F.col("v"))
    return g.agg(
        ratio(between / (k - 1), within / (n - k)).alias("f_value"), (k - 1).alias("df_between"), (n - k).alias("df_within")
    )


def anova_p(df: DataFrame, group: str, value: str) -> DataFrame:
    """The F statistic with its tail probability (computed on the single result row)."""
    a = anova(df, group, value)
    return a.withColumn("p_value", f_tail("f_value", F.col("df_between").cast("double"), F.col("df_within").cast("double")))


def normality(df: DataFrame, value: str) -> DataFrame:
    """D'Agostino K-squared from count, skewness and kurtosis."""
    base = df.agg(
        F.count(value).cast("double").alias("n"), F.skewness(value).alias("g1"), (F.kurtosis(value) + 3).alias("b2")
    )
    n, g1, b2 = F.col("n"), F.col("g1"), F.col("b2")
    # Skewness part.
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    delta = 1 / F.sqrt(F.log(w2) / 2)
    alpha = F.sqrt(2 / (w2 - 1))
    z1 = delta * F.asinh(y / alpha)
    # Kurtosis part.
    mean = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - mean) / F.sqrt(variance)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    inner = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    cube = F.signum(inner) * F.pow(F.abs(inner), F.lit(1.0 / 3.0))
    z2 = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return base.select(z1.alias("z_skew"), z2.alias("z_kurtosis"), k2.alias("k2"), F.exp(-k2 / 2).alias("p_value"))


def binned_information(df: DataFrame, columns: list[str], target: str, bins: int = 10) -> DataFrame:
    """Mutual information of quantile-binned columns with the binned target, in nats.

    Bins hold values above each of the exact quantile cuts, so ties never split.
    """
    names = {f"c{i}": i / bins for i in range(1, bins)}

    def bin_of(c: str) -> Column:
        return reduce(lambda a, b: a + b, [flag(F.col(c) > F.col("_q")[c][k]) for k in names])

    # Written once: the input may be a join, and both the cuts and the bins pass over it.
    kept = stored(df.select(*columns, target), "numbers")
    coded = with_quantiles(kept, [*columns, target], names).select(*[bin_of(c).alias(c) for c in columns], bin_of(target).alias("_t"))
    cells = coded.unpivot(["_t"], columns, "column", "_x").groupBy("column", "_x", "_t").agg(F.count(F.lit(1)).alias("_n"))
    # The contingency tables hold bins x bins cells per column, whatever the data size.
    cells = stored(cells, "cells")
    rows = cells.groupBy("column", "_x").agg(F.sum("_n").alias("_nx"))
    cols = cells.groupBy("column", "_t").agg(F.sum("_n").alias("_nt"))
    total = cells.groupBy("column").agg(F.sum("_n").alias("_all"))
    joined = cells.join(rows, ["column", "_x"]).join(cols, ["column", "_t"]).join(total, "column")
    p = F.col("_n") / F.col("_all")
    term = p * F.log(F.col("_n") * F.col("_all") / (F.col("_nx") * F.col("_nt")))
    return joined.groupBy("column").agg(F.sum(term).alias("information"))


def distance_outliers(df: DataFrame, columns: list[str], share: float = 0.01) -> DataFrame:
    """Rows whose summed squared z-scores exceed the exact (1 - share) quantile."""
    moments = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("s")).scalar()
    z = [F.pow(ratio(F.col(c) - moments[c]["m"], moments[c]["s"]), 2) for c in columns]
    scored = df.withColumn("distance", F.round(reduce(lambda a, b: a + b, z), 9))
    cut = with_quantiles(scored, ["distance"], {"cut": 1 - share})
    return cut.withColumn("is_outlier", flag(F.col("distance") > F.col("_q.distance.cut"))).drop("_q")


def treatment_means(df: DataFrame, treatment: str, outcome: str) -> DataFrame:
    return df.groupBy(treatment).agg(F.avg(outcome).alias("mean_outcome"), F.count(F.lit(1)).alias("n"))


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    return quantile_table(df, columns, {"median": 0.5})

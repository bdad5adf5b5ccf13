"""Profiles of a table: describe, histograms, densities, box statistics, checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ladders import melt, quantile_table, quantiles
from tablewright.functions.scalars import as_column, ratio
from tablewright.operators.missing import mode_table

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum, one row per column."""
    long = melt(df, columns).where("value is not null")
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return moments.join(quantile_table(df, columns, QUARTILES), "column")


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, commonest value and its count."""
    return mode_table(df, columns).select("column", "count", "unique", F.col("mode").alias("top"), "freq")


def category_counts(df: DataFrame, column: str, missing: str = "missing") -> DataFrame:
    """Counts and percents including the missing category."""
    counts = df.groupBy(F.coalesce(F.col(column), F.lit(missing)).alias(column)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / df.agg(F.count(F.lit(1))).scalar())


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of their kind."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), F.sum("n").alias("n_rows"))


def interaction_headline(ratings: DataFrame) -> DataFrame:
    """Rows, users, items, year range, density and sparsity."""
    base = ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"), F.count_distinct("userId").alias("n_users"),
        F.count_distinct("movieId").alias("n_items"), F.min(F.year("rated_at")).alias("year_min"),
        F.max(F.year("rated_at")).alias("year_max"),
    )
    density = ratio("n_ratings", F.col("n_users") * F.col("n_items"))
    return base.withColumn("density", density).withColumn("sparsity", 1 - density)


def corrected_skewness(c: str | Column) -> Column:
    """Sample-corrected skewness."""
    c = as_column(c).cast("double")
    n = F.count(c)
    return F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)


def bin_number(value: str | Column, low, high, bins: int) -> Column:
    """Bin 0..bins-1, the top edge in the last bin, values outside clipped to the range."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    clipped = F.least(F.greatest(as_column(value).cast("double"), low), high)
    return F.least(F.floor(F.try_divide((clipped - low) * bins, high - low)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, value: str, low, high, bins: int) -> DataFrame:
    """Counts of non-empty bins."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(bin_number(value, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histogram_2d(df: DataFrame, x: str, y: str, x_range: tuple, y_range: tuple, bins: int = 40) -> DataFrame:
    """Counts of non-empty cells; rows outside the ranges are left out."""
    inside = df.where((F.col(y) >= y_range[0]) & (F.col(y) <= y_range[1]))
    return inside.groupBy(
        bin_number(x, *x_range, bins).alias("x_bin"), bin_number(y, *y_range, bins).alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def kernel_density(df: DataFrame, group: str, value: str, low: float, high: float, points: int) -> DataFrame:
    """Gaussian density per group on a grid, bandwidth n^(-1/5) times the deviation.

    Equal values are counted first; each distinct value adds to the grid through a partial sum,
    so a group costs one row per task and grid point in the shuffle.
    """
    v = F.col(value).cast("double")
    counts = df.groupBy(group, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    spread = df.groupBy(group).agg(F.count(v).alias("_n"), F.stddev(v).alias("_sd"))
    spread = spread.withColumn("_h", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2)))
    step = (high - low) / (points - 1)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    cells = counts.join(spread, group).select(group, "_v", "_c", "_n", "_h", grid)
    z = (F.lit(low) + F.col("point") * step - F.col("_v")) / F.col("_h")
    mass = F.sum(F.col("_c") * F.exp(-z * z / 2) / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)))
    return cells.groupBy(group, "point").agg(mass.alias("density")).withColumn("x", F.lit(low) + F.col("point") * step)


def box_statistics(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 quartile ranges, and outlier count."""
    box = quantiles(df, value, QUARTILES, (group,))
    reach = (F.col("q75") - F.col("q25")) * 1.5
    fences = box.withColumn("_low", F.col("q25") - reach).withColumn("_high", F.col("q75") + reach)
    v = F.col(value)
    inside = v.between(F.col("_low"), F.col("_high"))
    whiskers = df.join(fences.select(group, "_low", "_high"), group).groupBy(group).agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return box.join(whiskers, group)


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Number of rows breaking each named rule; all rules in one aggregate."""
    row = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return row.unpivot([], list(rules), "rule", "violations")

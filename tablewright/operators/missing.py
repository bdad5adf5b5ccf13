"""Missing values: audit, drop, impute, and the two cleaning policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ladders import ladder, quantile_columns, quantile_table
from tablewright.functions.scalars import finite_or_zero, numeric_columns, string_columns
from tablewright.operators.columns import (
    BUILDING_CATEGORIES,
    in_bounds,
    members_or_null,
    money_columns,
    parsed_date,
    parsed_moment,
    postcode,
    text_to_boolean,
    trim_strings,
    with_lag_flag,
    constant_columns,
)
from tablewright.sources.tables import stored


def null_audit(df: DataFrame) -> DataFrame:
    """`(column, missing, percent)` for columns with missing values; one pass over the data."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot(["_rows"], df.columns, "column", "missing")
    return long.where(F.col("missing") > 0).select(
        "column", "missing", (F.col("missing") * 100.0 / F.col("_rows")).alias("percent")
    )


def sparse_columns(df: DataFrame, threshold: float) -> list[str]:
    """Columns whose share of nulls is above the threshold; one row reaches the driver."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold]


def drop_sparse(df: DataFrame, *thresholds: float) -> DataFrame:
    for t in thresholds:
        df = df.drop(*sparse_columns(df, t))
    return df


def _one_row(table: DataFrame, columns: list[str], value: str):
    """The per-column values of a long table as one struct, a scalar subquery."""
    wide = table.agg(F.struct(*[F.max(F.when(F.col("column") == c, F.col(value))).alias(c) for c in columns]).alias("s"))
    return wide.scalar()


def impute_median(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls of numeric columns to the exact median."""
    columns = columns or numeric_columns(df)
    medians = _one_row(quantile_table(df, columns, {"median": 0.5}), columns, "median")
    return df.withColumns({c: F.coalesce(F.col(c), medians[c]) for c in columns})


def mode_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(column, mode, freq)`, ties to the smallest value. Values are counted before they meet."""
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"), F.max("n").alias("freq"),
        F.count(F.lit(1)).alias("unique"), F.sum("n").alias("count"),
    )


def impute_mode(df: DataFrame, columns: list[str] | None = None, fallback: str = "Missing") -> DataFrame:
    """Nulls of string columns to the commonest value, or to `fallback` when there is none."""
    columns = columns or string_columns(df)
    modes = _one_row(mode_table(df, columns), columns, "mode")
    return df.withColumns({c: F.coalesce(F.col(c), modes[c], F.lit(fallback)) for c in columns})


def impute(df: DataFrame, medians: list[str], modes: list[str], fallback: str = "Missing") -> DataFrame:
    """`impute_median` and `impute_mode` of different columns from one pass: equal values are counted once, and only counts are kept."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), number.alias("number")) for c in modes]
    cells += [F.struct(F.lit(c).alias("column"), text.alias("text"), F.col(c).cast("double").alias("number")) for c in medians]
    counted = df.select(F.explode(F.array(*cells)).alias("r")).select("r.*").where("text is not null or number is not null")
    counted = stored(counted.groupBy("column", "text", "number").agg(F.count(F.lit(1)).alias("c")), "counted")
    if modes:
        best = counted.where("text is not null").groupBy("column").agg(F.min_by("text", F.struct(-F.col("c"), "text")).alias("mode"))
        one = _one_row(best, modes, "mode")
        df = df.withColumns({c: F.coalesce(F.col(c), one[c], F.lit(fallback)) for c in modes})
    if medians:
        steps = ladder(counted.where("number is not null"), "number", ("column",), {"n": F.sum("c")})
        one_median = _one_row(steps.groupBy("column").agg(*quantile_columns({"median": 0.5}, "number")), medians, "median")
        df = df.withColumns({c: F.coalesce(F.col(c), one_median[c]) for c in medians})
    return df


def clean_transactions(df: DataFrame) -> DataFrame:
    """Cleaning policy for sales rows: drop without product, impute, recompute money, parse dates."""
    kept = money_columns(impute(df.dropna(subset=["product_line"]), ["unit_price", "quantity"], ["customer_type"]))
    return (
        kept.withColumn("sale_date", parsed_date("date_str"))
        .withColumn("moment", parsed_moment("date_str", "time_str"))
        .dropna(subset=["sale_date"])
    )


def coerce_dates(df: DataFrame, day: str = "date_completude", missing: str = "date_completude_manquante") -> DataFrame:
    """A text of a day to a date and a text of a truth value to a boolean, where the columns exist; what cannot be read is null."""
    if day in df.columns:
        text = F.col(day).cast("string")
        df = df.withColumn(day, F.coalesce(text.try_cast("date"), parsed_date(text, "M/d/yyyy")))
    return df.withColumn(missing, text_to_boolean(F.col(missing).cast("string"))) if missing in df.columns else df


def clean_buildings(df: DataFrame) -> DataFrame:
    """Cleaning policy for buildings: narrow steps only, no shuffle."""
    return (
        df.transform(trim_strings)
        .withColumn("code_poste", postcode("code_poste"))
        .transform(coerce_dates)
        .transform(in_bounds, {"x": (-5, 10), "y": (41, 52)})
        .transform(with_lag_flag)
        .transform(members_or_null, "catg_loc_imb", BUILDING_CATEGORIES)
    )


def finite_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN, infinity and null to zero."""
    columns = columns or numeric_columns(df)
    return df.withColumns({c: finite_or_zero(c) for c in columns})


def drop_constant(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))

"""Projection, predicates, strings, dates, arrays: narrow operators without a shuffle."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import (
    as_column,
    flag,
    half_even,
    numeric_columns,
    ratio,
    string_columns,
)

# The category and state codes of the building data.
BUILDING_CATEGORIES = ["individuel", "entre 2 et 11", "entre 12 et 35", "entre 36 et 99", "100 et plus"]
COLLECTIVE_CATEGORIES = ["entre 2 et 11", "entre 12 et 35", "entre 36 et 99", "100 et plus"]
LARGE_CATEGORIES = ["entre 36 et 99", "100 et plus"]
DEPLOYED = "deploye"

# The genre names of the film data, in alphabetical order.
FILM_GENRES = [
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime", "Documentary", "Drama",
    "Fantasy", "Film-Noir", "Horror", "IMAX", "Musical", "Mystery", "Romance", "Sci-Fi",
    "Thriller", "War", "Western",
]
NO_GENRES = "(no genres listed)"


def pick(df: DataFrame, columns: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Keep the named columns, some under a new name."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in columns])


def in_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose values lie in all ranges, ends included; a null is outside."""
    for name, (low, high) in bounds.items():
        df = df.where(F.col(name).between(low, high))
    return df


def members_or_null(df: DataFrame, column: str, members: list[str]) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column).isin(members), F.col(column)))


def split_code(rank: Column, n: Column, n_test: int = 2, n_val: int = 2, min_rows: int = 10) -> Column:
    """0 train, 1 validation, 2 test for a row that is `rank`-th latest of `n`."""
    return (
        F.when(n < min_rows, 0)
        .when(rank <= n_test, 2)
        .when(rank <= n_test + n_val, 1)
        .otherwise(0)
    )


def basket_tier(total: str | Column) -> Column:
    """Right-closed amount classes."""
    total = as_column(total)
    return (
        F.when(total <= 100, "Low").when(total <= 300, "Mid").when(total <= 500, "High").otherwise("VeryHigh")
    )


def with_lag_flag(df: DataFrame, state: str = "imb_etat", name: str = "is_lagging") -> DataFrame:
    """1 unless the state is known to be deployed; a missing state counts as lagging."""
    return df.withColumn(name, F.when(F.col(state).eqNullSafe(DEPLOYED), 0).otherwise(1))


def building_flags(df: DataFrame) -> DataFrame:
    """Presence flags, the street number or -1, and the two category flags."""
    return df.select(
        "*",
        flag(F.col("batiment").isNotNull()).alias("has_building_label"),
        flag(F.col("code_poste").isNotNull()).alias("has_postcode"),
        F.coalesce(F.col("num_voie").try_cast("double"), F.lit(-1.0)).alias("num_voie_filled"),
        flag(F.col("catg_loc_imb") == "individuel").alias("is_individuel"),
        flag(F.col("catg_loc_imb").isin(LARGE_CATEGORIES)).alias("is_collective_large"),
    )


def physics_columns(df: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Products, logarithms and the guarded ratio of the optical link features."""
    c = F.col
    return df.select(
        "*",
        ratio(c("osnr"), c("nonlinear_effect") + F.lit(eps)).alias("osnr_over_nl"),
        (c("launch_power") * c("fiber_length")).alias("power_x_length"),
        (c("dispersion") * c("fiber_length")).alias("disp_x_length"),
        (c("nonlinear_effect") * c("launch_power")).alias("nl_x_power"),
        F.log1p("osnr").alias("log_osnr"),
        F.log1p("launch_power").alias("log_power"),
    )


def pairwise_products(df: DataFrame, columns: list[str]) -> DataFrame:
    """All products of two of the columns, squares included."""
    pairs = combinations_with_replacement(columns, 2)
    return df.select("*", *[(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for a, b in pairs])


def money_columns(df: DataFrame, price: str = "unit_price", quantity: str = "quantity") -> DataFrame:
    """Total, cost and tax recomputed from price and quantity, each rounded to 4 digits."""
    amount = F.col(price) * F.col(quantity)
    return (
        df.withColumn("total", half_even(amount * 1.05, 4))
        .withColumn("cogs", half_even(amount, 4))
        .withColumn("tax", half_even(F.col("cogs") * 0.05, 4))
        .withColumn("gross_income", F.col("tax"))
    )


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column; an empty string becomes null."""
    text = set(string_columns(df))
    return df.select(
        *[F.nullif(F.trim(c), F.lit("")).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def postcode(c: str | Column, width: int = 5) -> Column:
    """Number-like text to a zero-padded code; longer codes are left whole."""
    digits = as_column(c).try_cast("double").try_cast("long").cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def text_to_boolean(c: str | Column) -> Column:
    low = F.lower(as_column(c))
    return F.when(low.isin("true", "t"), True).when(low.isin("false", "f"), False)


def release_year(title: str | Column, missing: int | None = None) -> Column:
    """Four digits in parentheses, first match."""
    digits = F.regexp_extract(as_column(title), r"\((\d{4})\)", 1)
    year = F.nullif(digits, F.lit("")).try_cast("int")
    return year if missing is None else F.coalesce(year, F.lit(missing))


def normalised_tag(c: str | Column) -> Column:
    """Lower case, anything but letters, digits, dash and apostrophe to one space."""
    text = F.regexp_replace(F.lower(F.trim(as_column(c))), r"[^a-z0-9\s\-']", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def genre_flags(genres: list[str], column: str = "genres", prefix: str = "g_") -> list[Column]:
    """One 0/1 column per genre, by whole token."""
    tokens = F.split(F.col(column), r"\|")
    return [flag(F.array_contains(tokens, g)).alias(f"{prefix}{g}") for g in genres]


def exploded_genres(movies: DataFrame) -> DataFrame:
    """(movieId, genre), the placeholder dropped."""
    return movies.select("movieId", F.explode(F.split("genres", r"\|")).alias("genre")).where(
        F.col("genre") != NO_GENRES
    )


def decade(year: str | Column) -> Column:
    return (F.floor(as_column(year) / 10) * 10).cast("int")


def parsed_date(c: str | Column, pattern: str = "M/d/yy") -> Column:
    """Date or null; two-digit years are read as 20xx."""
    return F.try_to_timestamp(as_column(c), F.lit(pattern)).cast("date")


def parsed_moment(date: str | Column, time: str | Column, pattern: str = "M/d/yy H:mm") -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", as_column(date), as_column(time)), F.lit(pattern))


def whole_days(first: str | Column, last: str | Column) -> Column:
    """Full days between two moments (not midnights crossed)."""
    seconds = F.unix_timestamp(as_column(last).cast("timestamp")) - F.unix_timestamp(
        as_column(first).cast("timestamp")
    )
    return F.floor(seconds / 86400).cast("int")


def calendar_columns(df: DataFrame, moment: str) -> DataFrame:
    """Hour, day of week (0 = Monday), month, their names, and the weekend flag."""
    m = F.col(moment)
    return df.select(
        "*",
        F.hour(m).alias("hour"),
        F.weekday(m).alias("dow"),
        F.date_format(m, "EEEE").alias("day_name"),
        F.month(m).alias("month"),
        F.date_format(m, "MMMM").alias("month_name"),
        flag(F.weekday(m) >= 5).alias("is_weekend"),
    )


def constant_columns(df: DataFrame) -> list[str]:
    """Numeric columns whose deviation is zero (one aggregate, one row to the driver)."""
    names = numeric_columns(df)
    row = df.agg(*[F.stddev(F.col(c).cast("double")).alias(c) for c in names]).first()
    return [c for c in names if row[c] is not None and row[c] == 0.0]

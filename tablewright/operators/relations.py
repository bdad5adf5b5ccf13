"""Joins and set operations.

No join carries a broadcast hint unless its small side has a fixed bound: adaptive execution
broadcasts a side whose measured size is small and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_group_values(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Left join of group results back to the rows; a null key finds no group."""
    return df.join(groups, key, "left")


def restrict_to(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_semi")


def without_pairs(df: DataFrame, seen: DataFrame, on: list[str]) -> DataFrame:
    return df.join(seen.select(*on), on, "left_anti")


def genre_means(ratings: DataFrame, films: DataFrame, by: list[str]) -> DataFrame:
    """Counts and mean rating by film attributes: ratings shrink to one row per film first."""
    per_film = ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("_n"), F.sum("rating").alias("_s"))
    joined = per_film.join(films, "movieId")
    return joined.groupBy(*by).agg(
        F.sum("_n").alias("n"), (F.sum("_s") / F.sum("_n")).alias("mean_rating")
    )


def filled_from(df: DataFrame, other: DataFrame, key: str, value: str, fallback: str) -> DataFrame:
    """`value` looked up in `other`, or the row's own `fallback` where it is missing."""
    joined = df.join(other.select(key, value), key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.col(fallback)))


def all_keys(frames: list[DataFrame], key: str) -> DataFrame:
    """Distinct keys over several frames; each frame is reduced before the union."""
    parts = [f.select(key).distinct() for f in frames]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()

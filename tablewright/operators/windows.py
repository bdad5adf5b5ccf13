"""Ranks, splits by recency, cumulative precision, top-n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.ladders import average_rank, split_row_number, with_value_piece
from tablewright.operators.columns import split_code


def recency_rank(ratings: DataFrame) -> DataFrame:
    """`rn_desc` and `user_n`: position from the latest rating of a user, and the user's count.

    A very active user is numbered in time slices, so no task sorts the whole history.
    """
    stamped = ratings.withColumn("_epoch", F.unix_timestamp(F.col("rated_at").cast("timestamp")))
    sliced = with_value_piece(stamped, "_epoch")
    order = [F.desc("rated_at"), F.desc("movieId")]
    return split_row_number(sliced, ("userId",), order, "rn_desc", "_piece", descending=True, total="user_n").drop("_epoch")


def latest(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "rn_desc") -> DataFrame:
    """The n latest rows per key. The limit is applied in every task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def leave_last_out(ratings: DataFrame, n_test: int = 2, n_val: int = 2, min_rows: int = 10) -> DataFrame:
    """Split code per rating: last `n_test` of a user to test, `n_val` before them to validation.

    Expects one rating per user and item.

    Only the few latest rows of a user need a rank, so the window works on those; counts come
    from a plain aggregation, and the rest is joined back on the pair.
    """
    tail = latest(ratings, ["userId"], [F.desc("rated_at"), F.desc("movieId")], n_test + n_val)
    counts = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("_n"))
    coded = tail.join(counts, "userId").select(
        "userId", "movieId", split_code(F.col("rn_desc"), F.col("_n"), n_test, n_val, min_rows).alias("split")
    )
    joined = ratings.join(coded, ["userId", "movieId"], "left")
    return joined.withColumn("split", F.coalesce("split", F.lit(0)))


def with_rating_context(ratings: DataFrame, films: DataFrame) -> DataFrame:
    """Hour, weekday (1 = Monday) and age of the film at the time of rating."""
    return ratings.join(films.select("movieId", "release_year"), "movieId", "left").select(
        *ratings.columns, F.hour("rated_at").alias("hour"), (F.weekday("rated_at") + 1).alias("dow"),
        (F.year("rated_at") - F.col("release_year")).alias("movie_age"),
    )


def with_percentile_rank(df: DataFrame, value: str, name: str = "rank_pct") -> DataFrame:
    """Average-tie rank divided by the number of rows."""
    ranks = average_rank(df, value).select(
        F.col(value).alias("_v"), (F.col("rank") / F.col("n_total")).alias(name)
    )
    return df.join(ranks, F.col(value).cast("double") == F.col("_v"), "left").drop("_v")


def cumulative_precision(hits: DataFrame, user: str = "userId", rank: str = "rank", hit: str = "hit") -> DataFrame:
    """Hits up to each rank divided by the rank; lists are top-k, so groups are bounded."""
    w = Window.partitionBy(user).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return hits.withColumn("precision_at", F.sum(hit).over(w) / F.col(rank))


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, keys: list[str], n: int, *order: Column | str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def last_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Values of the last row per key: an aggregate, so partial results are merged before the shuffle."""
    row = F.struct(*values)
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_r"))
    return last.select(*keys, *[F.col("_r")[v].alias(v) for v in values])

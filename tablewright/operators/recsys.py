"""Recommenders. Every scorer returns `(userId, movieId, score, rank)`, best k unseen items."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.ladders import global_rank, split_row_number, with_value_piece
from tablewright.functions.scalars import hash_bucket, nine_digits, ratio, unit_vector
from tablewright.operators.products import hashed, nearest_rows, sparse_times_dense, weighted_topk
from tablewright.operators.retrieval import block_topk
from tablewright.session import pieces
from tablewright.sources.tables import stored

LIKED = 3.5
#: Pairs that meet the neighbours of their item in one round.
ROUND_PAIRS = 1 << 21


def contiguous_ids(df: DataFrame, key: str, name: str) -> DataFrame:
    """`(key, name)` with 0-based numbers in key order, numbered range by range."""
    keys = stored(df.select(key).distinct(), "keys")
    ranged = with_value_piece(keys.withColumn("_k", F.col(key).cast("double")), "_k")
    numbered = split_row_number(ranged, (), [F.col(key)], name, "_piece")
    return numbered.select(key, (F.col(name) - 1).cast("int").alias(name))


def interactions(ratings: DataFrame) -> DataFrame:
    """Ratings with contiguous user and item numbers, the latest rating of a pair kept."""
    # Stored: the numbers of users and of items and the result all read it.
    latest = stored(ratings.groupBy("userId", "movieId").agg(F.max_by("rating", "rated_at").alias("rating")), "latest")
    return latest.join(contiguous_ids(latest, "userId", "user_index"), "userId").join(
        contiguous_ids(latest, "movieId", "item_index"), "movieId"
    )


def mean_predictions(train: DataFrame, pairs: DataFrame, default: float = LIKED) -> DataFrame:
    """Global, user and item means and the bias model for the given pairs."""
    mu = F.coalesce(train.agg(F.avg("rating")).scalar(), F.lit(default))
    users = train.groupBy("userId").agg(F.avg("rating").alias("_u"))
    items = train.groupBy("movieId").agg(F.avg("rating").alias("_i"))
    joined = pairs.join(users, "userId", "left").join(items, "movieId", "left").withColumn("global_mean", mu)
    return joined.select(
        *pairs.columns, "global_mean", F.coalesce("_u", "global_mean").alias("user_mean"),
        F.coalesce("_i", "global_mean").alias("item_mean"),
        (F.col("global_mean") + F.coalesce(F.col("_u") - F.col("global_mean"), F.lit(0.0))
         + F.coalesce(F.col("_i") - F.col("global_mean"), F.lit(0.0))).alias("bias"),
    )


def popularity_topk(train: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The k most popular items each user has not seen.

    Let a user's seen items have popularity ranks r(1) < r(2) < ... The t-th unseen item has rank
    t plus the number of seen items with r(s) - s < t. So k counts per user replace a table of
    users by candidates, however long a history is.
    """
    counts = train.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))
    ranked = global_rank(counts, "n", "movieId", "pop_rank")
    sizes = stored(train.join(users.select("userId"), "userId", "left_semi").groupBy("userId").agg(F.count(F.lit(1)).alias("_h")), "sizes")
    longest = sizes.agg(F.max("_h")).first()[0] or 0
    # With h seen items r(s) - s < k needs r(s) < h + k: less popular items matter for no count and are on no list.
    ranked = stored(ranked.where(F.col("pop_rank") <= longest + k), "popular")
    seen = train.select("userId", "movieId").join(ranked, "movieId").join(sizes, "userId").where(F.col("pop_rank") < F.col("_h") + k)
    seen = stored(seen.select("userId", "pop_rank"), "seen")
    n = pieces(train.sparkSession)
    seen = seen.withColumn("_piece", F.floor((F.col("pop_rank") - 1) * F.lit(n) / F.lit(longest + k)))
    placed = split_row_number(seen, ("userId",), [F.col("pop_rank")], "_s", "_piece")
    gap = F.col("pop_rank") - F.col("_s")
    shifts = placed.groupBy("userId").agg(
        F.array(*[F.count_if(gap < t) + t for t in range(1, k + 1)]).alias("_ranks")
    )
    plain = F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long"))
    wanted = users.select("userId").distinct().join(shifts, "userId", "left")
    listed = wanted.select("userId", F.posexplode(F.coalesce("_ranks", plain)).alias("_t", "pop_rank"))
    return listed.join(ranked, "pop_rank").select(
        "userId", "movieId", F.col("n").cast("double").alias("score"), (F.col("_t") + 1).alias("rank")
    )


def cosine_neighbours(ratings: DataFrame, item: str, user: str, k: int = 50) -> DataFrame:
    """`(item, neighbour, sim)`: the k most similar items by cosine over common users, exact."""
    return nearest_rows(ratings, item, user, "rating", k)


def item_knn_topk(train: DataFrame, neighbours: DataFrame, k: int = 10) -> DataFrame:
    """Similarity-weighted mean of a user's ratings over each rated item's neighbour list."""
    rated = train.select("userId", F.col("movieId").alias("_rated"), "rating")
    links = neighbours.select(F.col("movieId").alias("_rated"), F.col("neighbour").alias("movieId"), "sim")
    return weighted_topk(rated, links, "userId", "_rated", "rating", "movieId", "sim", "sim", k, train)


def item_knn_predictions(train: DataFrame, neighbours: DataFrame, pairs: DataFrame, default: float = LIKED) -> DataFrame:
    """Predicted rating of given pairs, `default` where no rated item lists the target."""
    links = neighbours.select(F.col("movieId").alias("_j"), F.col("neighbour").alias("movieId"), "sim")
    rated = train.select("userId", F.col("movieId").alias("_j"), F.col("rating").alias("_r"))

    def scored(pairs: DataFrame, rated: DataFrame) -> DataFrame:
        found = pairs.join(links, "movieId").join(rated, ["userId", "_j"])
        return found.groupBy("userId", "movieId").agg(
            ratio(F.sum(F.col("sim") * F.col("_r")), F.sum(F.abs("sim"))).alias("prediction"))

    asked = pairs.select("userId", "movieId")
    rounds = -(-pairs.count() // ROUND_PAIRS)
    if rounds <= 1:
        scores = scored(asked, rated)
    else:
        # A user is in one round; the shuffle files of a round go when its scores are written.
        turn = hashed("userId", rounds, 13)
        scores = reduce(DataFrame.unionByName, [stored(scored(asked.where(turn == r), rated.where(turn == r)), "scores") for r in range(rounds)])
    joined = pairs.join(scores, ["userId", "movieId"], "left")
    return joined.withColumn("prediction", F.coalesce("prediction", F.lit(default)))


def user_knn_topk(train: DataFrame, neighbours: DataFrame, k: int = 10) -> DataFrame:
    """Similarity-weighted mean of the ratings of a user's neighbours."""
    near = neighbours.select("userId", F.col("neighbour").alias("_near"), "sim")
    rated = train.select(F.col("userId").alias("_near"), "movieId", "rating")
    return weighted_topk(near, rated, "userId", "_near", "sim", "movieId", "rating", "sim", k, train)


def content_profiles(train: DataFrame, items: DataFrame) -> DataFrame:
    """Unit vector per user: rating-weighted sum of unit item vectors."""
    units = items.select("movieId", unit_vector("embedding").alias("embedding"))
    sums = sparse_times_dense(train, units, "userId", "movieId", "rating", "embedding", "profile")
    return sums.select("userId", unit_vector("profile").alias("profile"))


def vector_topk(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """Best unseen items per user by inner product of `profile` and `embedding`."""
    found = block_topk(users, items, k, "userId", "movieId", "profile", "embedding", seen=seen)
    return found.select(F.col("query_id").alias("userId"), F.col("item_id").alias("movieId"), "score", "rank")


def content_topk(train: DataFrame, items: DataFrame, k: int = 10, users: DataFrame | None = None, catalogue: DataFrame | None = None) -> DataFrame:
    """Best unseen items per user by the cosine of item vector and profile, the rating-weighted sum of seen unit vectors.

    `users` and `catalogue` name who gets a list and what may be on it (default: users of the training
    rows, items with a vector). An item without a vector scores -1; a user none of whose items has one
    has the profile zero, with which every item that has a vector scores 0.
    """
    units = stored(items.select("movieId", unit_vector("embedding").alias("embedding")), "item-vectors")
    profiles = content_profiles(train, units)
    users = train.select("userId") if users is None else users.select("userId")
    catalogue = units.select("movieId") if catalogue is None else catalogue.select("movieId")
    width = units.agg(F.max(F.size("embedding"))).first()[0] or 0
    # One place more: 1 for every user, and -1 there and nothing else for an item without a vector.
    zero = F.array_repeat(F.lit(0.0), F.lit(width))
    wide_users = users.distinct().join(profiles, "userId", "left").select("userId", F.concat(F.coalesce("profile", zero), F.array(F.lit(1.0))).alias("profile"))
    there = catalogue.distinct().join(units, "movieId", "left")
    last = F.when(F.col("embedding").isNull(), -1.0).otherwise(0.0)
    wide_items = there.select("movieId", F.concat(F.coalesce("embedding", zero), F.array(last)).alias("embedding"))
    return vector_topk(stored(wide_users, "user-vectors"), stored(wide_items, "catalogue"), k, seen=train)


def z_scores(scores: DataFrame, name: str) -> DataFrame:
    """Scores of each user's list less its mean, over its deviation unless that is tiny."""
    stats = scores.groupBy("userId").agg(F.avg("score").alias("_m"), F.stddev_pop("score").alias("_s"))
    centred = F.col("score") - F.col("_m")
    z = F.when(F.col("_s") < 1e-9, centred).otherwise(centred / F.col("_s"))
    return scores.join(stats, "userId").select("userId", "movieId", z.alias(name))


def blend(a: DataFrame, b: DataFrame, alpha: float = 0.7) -> DataFrame:
    """alpha * z(a) + (1 - alpha) * z(b) over the items both lists hold.

    Both z-scores are written, so that the shuffle files of one go before the other is made and joined.
    """
    joined = stored(z_scores(a, "_a"), "z-scores").join(stored(z_scores(b, "_b"), "z-scores"), ["userId", "movieId"])
    return joined.select("userId", "movieId", (alpha * F.col("_a") + (1 - alpha) * F.col("_b")).alias("score"))


def _list_moments(users: DataFrame, items: DataFrame) -> DataFrame:
    """Mean and deviation of each user's scores over all items, without making the scores.

    The mean score is the product with the mean item, the variance a quadratic form of the item
    covariance. That matrix has (vector length)^2 entries whatever the number of items; it is
    summed batch by batch from centred vectors, so equal scores have no deviation.
    """
    wide = items.select(F.col("embedding").cast("array<double>").alias("v"))
    places = wide.select(F.posexplode("v").alias("cell", "x")).groupBy("cell").agg(F.avg("x").alias("m")).orderBy("cell")
    mean = np.array([row["m"] for row in places.collect()])

    def gram(batches):
        for pdf in batches:
            v = np.stack(pdf["v"].to_numpy()) - mean
            yield pd.DataFrame({"cell": np.arange(v.shape[1] ** 2), "part": (v.T @ v).ravel(), "n": len(v)})

    cells = wide.mapInPandas(gram, "cell int, part double, n long").groupBy("cell").agg((F.sum("part") / F.sum("n")).alias("part"))
    # (vector length)^2 numbers: a bound set by the model, not by the data.
    cov = np.array([row["part"] for row in cells.orderBy("cell").collect()]).reshape(len(mean), len(mean))

    @F.pandas_udf("struct<m double, s double>")
    def moments(profile: pd.Series) -> pd.DataFrame:
        if profile.empty:
            return pd.DataFrame({"m": [], "s": []})
        p = np.stack(profile.to_numpy()).astype(np.float64)
        var = np.einsum("ij,jk,ik->i", p, cov, p, optimize=True)
        return pd.DataFrame({"m": p @ mean, "s": np.sqrt(np.maximum(var, 0))})

    return users.withColumn("_z", moments("profile")).select(
        "userId", "profile", F.col("_z.m").alias("m"), F.col("_z.s").alias("s")
    )


def hybrid_topk(
    users_a: DataFrame, items_a: DataFrame, users_b: DataFrame, items_b: DataFrame, alpha: float, k: int,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Blend of two vector scorers, z-scored per user over the whole catalogue.

    z-scoring is linear in the scores, so the blend is one inner product of joined, rescaled
    vectors less a constant per user; no user by item table is made.
    """
    # Both scorers are z-scored over the items that both know.
    items_a, items_b = items_a.join(items_b, "movieId", "left_semi"), items_b.join(items_a, "movieId", "left_semi")
    a = _list_moments(users_a, items_a).select("userId", F.col("profile").alias("_pa"), F.col("m").alias("_ma"), F.col("s").alias("_sa"))
    b = _list_moments(users_b, items_b).select("userId", F.col("profile").alias("_pb"), F.col("m").alias("_mb"), F.col("s").alias("_sb"))

    def scale(weight: float, s: Column) -> Column:
        return weight / F.when(s < 1e-9, 1.0).otherwise(s)

    wa, wb = scale(alpha, F.col("_sa")), scale(1 - alpha, F.col("_sb"))
    both = a.join(b, "userId").select(
        "userId", (wa * F.col("_ma") + wb * F.col("_mb")).alias("_shift"),
        F.concat(F.transform("_pa", lambda x: x * wa), F.transform("_pb", lambda x: x * wb)).alias("profile"),
    )
    both = stored(both, "hybrid-users")
    items = items_a.select("movieId", F.col("embedding").cast("array<double>").alias("_a")).join(
        items_b.select("movieId", F.col("embedding").cast("array<double>").alias("_b")), "movieId"
    ).select("movieId", F.concat("_a", "_b").alias("embedding"))
    top = vector_topk(both, stored(items, "hybrid-items"), k, seen)
    return top.join(both.select("userId", "_shift"), "userId").select(
        "userId", "movieId", (F.col("score") - F.col("_shift")).alias("score"), "rank"
    )


def negatives(train: DataFrame, per_positive: int = 4, seed: int = 42) -> DataFrame:
    """`(userId, movieId, draw, negative)`: unseen items drawn for every liked pair.

    A draw picks the j-th item the user has not seen, j by hash, so no draw is ever rejected. The
    j-th unseen number is j plus the number of seen items with (number - position) <= j; draws and
    seen items of a user are merged in value order and that count is a running sum, taken slice by
    slice.
    """
    items = contiguous_ids(train, "movieId", "item_index")
    n_items = items.agg(F.count(F.lit(1))).scalar()
    n = pieces(train.sparkSession)
    indexed = train.select("userId", "movieId", "rating").join(items, "movieId")
    sliced = indexed.withColumn("_piece", F.floor(F.col("item_index") * F.lit(n) / n_items))
    seen = split_row_number(sliced, ("userId",), [F.col("item_index")], "_s", "_piece", total="_seen")
    marks = seen.select("userId", (F.col("item_index") - F.col("_s") + 1).cast("long").alias("_v"), F.lit(1).alias("_mark"),
                        F.lit(None).cast("long").alias("movieId"), F.lit(None).cast("int").alias("draw"))
    draws = seen.where((F.col("rating") >= LIKED) & (F.col("_seen") < n_items)).withColumn(
        "draw", F.explode(F.sequence(F.lit(1), F.lit(per_positive))))
    key = F.concat_ws("-", "userId", "movieId", "draw")
    draws = draws.select("userId", F.pmod(hash_bucket(key, seed), n_items - F.col("_seen")).cast("long").alias("_v"),
                         F.lit(0).alias("_mark"), F.col("movieId").cast("long").alias("movieId"), "draw")
    merged = marks.unionByName(draws).withColumn("_piece", F.floor(F.col("_v") * F.lit(n) / n_items))
    sums = merged.groupBy("userId", "_piece").agg(F.sum("_mark").alias("_m"))
    earlier = Window.partitionBy("userId").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("userId", "_piece", F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_base"))
    local = Window.partitionBy("userId", "_piece").orderBy("_v", F.desc("_mark")).rowsBetween(Window.unboundedPreceding, 0)
    placed = merged.join(bases, ["userId", "_piece"]).withColumn(
        "item_index", (F.col("_v") + F.col("_base") + F.sum("_mark").over(local)).cast("int"))
    chosen = placed.where("_mark = 0").select("userId", "movieId", "draw", "item_index")
    return chosen.join(items.select("item_index", F.col("movieId").alias("negative")), "item_index").drop("item_index")


def sequences(ratings: DataFrame, max_len: int = 50, min_items: int = 3) -> DataFrame:
    """Input and target item sequences in time order, the last `max_len` steps, zero-padded left.

    Only the latest `max_len + 1` ratings of a user reach the list.
    """
    items = contiguous_ids(ratings, "movieId", "item_index")
    w = Window.partitionBy("userId").orderBy(F.desc("rated_at"), F.desc("movieId"))
    tail = ratings.select("userId", "movieId", "rated_at").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_len + 1)
    listed = tail.join(items, "movieId").groupBy("userId").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("_rn")).alias("o"), (F.col("item_index") + 1).alias("i")))).alias("_l"))
    full = listed.where(F.size("_l") >= min_items).select("userId", F.transform("_l", lambda s: s["i"]).alias("_s"))
    n = F.size("_s") - 1
    pad = F.array_repeat(F.lit(0), F.lit(max_len) - n)
    return full.select(
        "userId", F.concat(pad, F.slice("_s", F.lit(1), n)).alias("input"), F.concat(pad, F.slice("_s", F.lit(2), n)).alias("target")
    )

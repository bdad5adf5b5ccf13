"""Samples and splits decided by a hash of the row key, so they repeat on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ladders import global_rank, split_row_number, with_hash_piece
from tablewright.functions.scalars import hash_bucket, hash_fraction


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """All rows of a fraction of the keys: a filter, no shuffle."""
    return df.where(hash_fraction(key, seed) < fraction)


def sample_active(df: DataFrame, key: str, fraction: float, min_rows: int, seed: int = 42) -> DataFrame:
    """All rows of a sampled share of the keys that have at least `min_rows` rows."""
    active = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    return df.where(hash_fraction(key, seed) < fraction).join(active.select(key), key, "left_semi")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in hash order: a top-n per task and a merge."""
    return df.withColumn("_h", hash_bucket(key, seed)).orderBy("_h", key).limit(n).drop("_h")


def sample_per_class(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows per class in hash order; each task keeps at most n rows per class."""
    from tablewright.operators.windows import top_per_group

    tagged = df.withColumn("_h", hash_bucket(key, seed))
    return top_per_group(tagged, [label], n, "_h", key).drop("_h", "rank")


def systematic_sample(df: DataFrame, key: str, step: int = 50) -> DataFrame:
    return df.where(F.pmod(F.col(key), F.lit(step)) == 0)


def cap_users(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of n keys drawn in hash order."""
    chosen = sample_rows(df.select(key).distinct(), key, n, seed)
    return df.join(chosen, key, "left_semi")


def random_split(key: str | Column, shares: dict[str, float], seed: int = 42) -> Column:
    """Name of the split a key falls into; shares are taken in order, the last takes the rest."""
    u = hash_fraction(key, seed)
    names = list(shares)
    edge, out = 0.0, None
    for name in names[:-1]:
        edge += shares[name]
        out = F.when(u < edge, name) if out is None else out.when(u < edge, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


def stratified_split(df: DataFrame, label: str, key: str, share: float, name: str = "is_test", seed: int = 42) -> DataFrame:
    """1 for the given share of every class, taken in hash order.

    Classes are few and large, so each is ranked in hash pieces, not in one task.
    """
    pieced = with_hash_piece(df, key, seed)
    ranked = split_row_number(pieced, (label,), [hash_bucket(key, seed), F.col(key)], "_rn", "_piece", total="_n")
    position = F.try_divide((F.col("_rn") - 1).cast("double"), (F.col("_n") - 1).cast("double"))
    return ranked.withColumn(name, F.when(position < share, 1).otherwise(0)).drop("_rn", "_n")


def promote_to_validation(manifest: DataFrame, label: str, key: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """Move a share of every training class to validation and keep the original validation rows."""
    train = stratified_split(manifest.where("split = 'train'"), label, key, share, "_move", seed)
    moved = train.withColumn("split", F.when(F.col("_move") == 1, "val").otherwise("train")).drop("_move")
    return moved.unionByName(manifest.where("split <> 'train'"))


def group_folds(df: DataFrame, group: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Fold per row such that a group never straddles folds.

    Groups are dealt out by falling size in a back-and-forth order, which balances fold sizes.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", hash_bucket(group, seed))
    ranked = global_rank(sizes, "_n", "_h", "_rank")
    turn = F.pmod(F.col("_rank") - 1, F.lit(2 * k))
    fold = F.when(turn < k, turn).otherwise(2 * k - 1 - turn).cast("int")
    return df.join(ranked.select(group, fold.alias("fold")), group)


def hash_folds(key: str | Column, k: int = 5, seed: int = 42) -> Column:
    return F.pmod(hash_bucket(key, seed), F.lit(k)).cast("int")

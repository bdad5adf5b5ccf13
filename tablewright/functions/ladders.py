"""Exact order statistics without a whole group ever sitting in one task.

`percentile`, `percent_rank` and a running sum over all rows need the sorted group in one
place. Here equal values are counted first, the distinct values are cut into ranges, each
range is summed, and a running sum inside a range starts from the sum of the ranges before
it. Only the per-range sums of a group (one row per range) meet in a single window.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalars import HASH_SPACE, hash_bucket
from tablewright.session import pieces
from tablewright.sources.tables import stored


def with_value_piece(df: DataFrame, value: str, name: str = "_piece") -> DataFrame:
    """Add the number of the value range a row falls into, in ascending value order.

    The cut points are a fixed, small number of approximate quantiles. They only balance the
    ranges; any cut points give the same exact results.
    """
    n = pieces(df.sparkSession)
    probe = df.select(F.col(value).cast("double").alias(value))
    cuts = probe.approxQuantile(value, [i / n for i in range(1, n)], 0.25 / n)
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    return Bucketizer(splits=splits, inputCol=value, outputCol=name).transform(df)


def ladder(
    df: DataFrame,
    value: str,
    keys: tuple[str, ...] = (),
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per distinct value: each measure, its sum over smaller values, its group total.

    For measure `n` the result holds `n`, `n_before` and `n_total`. Null values are left out.
    """
    measures = measures or {"n": F.count(F.lit(1))}
    names = list(measures)
    steps = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias(value))
        .agg(*[m.alias(n) for n, m in measures.items()])
    )
    # Stored, so that the rows are aggregated once for the cut points, the sums and the result.
    steps = with_value_piece(stored(steps, "ladder"), value)
    per_piece = steps.groupBy(*keys, "_piece").agg(*[F.sum(n).alias(f"_s_{n}") for n in names])
    group = Window.partitionBy(*keys) if keys else Window.partitionBy()
    earlier = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_piece.select(
        *keys,
        "_piece",
        *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in names],
        *[F.sum(f"_s_{n}").over(group).alias(f"{n}_total") for n in names],
    )
    inside = (
        Window.partitionBy(*keys, "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return steps.join(bases, [*keys, "_piece"]).select(
        *keys,
        value,
        *names,
        *[
            (F.col(f"_b_{n}") + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias(f"{n}_before")
            for n in names
        ],
        *[f"{n}_total" for n in names],
    )


def melt(df: DataFrame, columns: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Wide numeric columns to `(keys, column, value)`."""
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(keys), columns, "column", "value")


def quantile_columns(probabilities: dict[str, float], value: str = "value") -> list[Column]:
    """Aggregates over a ladder that give linearly interpolated quantiles."""
    out = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        low, high = F.floor(position), F.ceil(position)

        def at(rank: Column) -> Column:
            here = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
            return F.max(F.when(here, F.col(value)))

        weight = F.max(position - low)
        lo, hi = at(low), at(high)
        out.append((lo + (hi - lo) * weight).alias(name))
    return out


def quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], keys: tuple[str, ...] = ()
) -> DataFrame:
    """Exact quantiles of one column, one row per group (one row without keys)."""
    steps = ladder(df.select(*keys, F.col(value).alias("_x")), "_x", keys)
    aggs = quantile_columns(probabilities, "_x")
    return steps.groupBy(*keys).agg(*aggs) if keys else steps.agg(*aggs)


def quantile_table(
    df: DataFrame, columns: list[str], probabilities: dict[str, float], keys: tuple[str, ...] = ()
) -> DataFrame:
    """Exact quantiles of many columns in one pass, as rows `(keys, column, ...)`."""
    return quantiles(melt(df, columns, keys), "value", probabilities, (*keys, "column"))


def with_quantiles(
    df: DataFrame, columns: list[str], probabilities: dict[str, float], name: str = "_q"
) -> DataFrame:
    """Add a struct `name.<column>.<probability name>` holding exact global quantiles.

    One subquery serves all columns, and it is referenced once however often the struct is used.
    """
    table = quantile_table(df, columns, probabilities)
    per_column = [F.max(F.when(F.col("column") == c, F.struct(*probabilities))).alias(c) for c in columns]
    return df.withColumn(name, table.agg(F.struct(*per_column).alias("q")).scalar())


def average_rank(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """`(keys, value, rank, n_total)` with tied values sharing their mean rank."""
    return ladder(df.select(*keys, F.col(value).alias("_x")), "_x", keys).select(
        *keys, F.col("_x").alias(value), (F.col("n_before") + (F.col("n") + 1) / 2).alias("rank"), "n_total"
    )


def split_row_number(
    df: DataFrame,
    keys: tuple[str, ...],
    order: list[Column],
    name: str,
    piece: str,
    descending: bool = False,
    total: str | None = None,
) -> DataFrame:
    """Row number inside each group, with large groups numbered piece by piece.

    `piece` must rise with the first order column. `total` optionally names a column that
    receives the size of the group.
    """
    sizes = df.groupBy(*keys, piece).agg(F.count(F.lit(1)).alias("_size"))
    group = Window.partitionBy(*keys)
    direction = F.col(piece).desc() if descending else F.col(piece).asc()
    earlier = group.orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        *keys,
        piece,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"),
        *([F.sum("_size").over(group).alias(total)] if total else []),
    )
    local = Window.partitionBy(*keys, piece).orderBy(*order)
    return (
        df.join(bases, [*keys, piece])
        .withColumn(name, F.row_number().over(local) + F.col("_base"))
        .drop("_base", piece)
    )


def with_hash_piece(df: DataFrame, key: str, seed: int, name: str = "_piece") -> DataFrame:
    """Evenly filled pieces in the order of the key's hash."""
    n = pieces(df.sparkSession)
    return df.withColumn(name, F.floor(hash_bucket(key, seed) * F.lit(n) / F.lit(float(HASH_SPACE))))


def global_rank(df: DataFrame, value: str, tie: str, name: str = "rank") -> DataFrame:
    """Position of every row by `value` descending, ties by numeric `tie` ascending.

    The rows above a value come from the ladder of counts; the rows sharing a value are
    numbered piece by piece, so neither the table nor a popular value needs a single task.
    """
    df = stored(df, "ranked")
    above = ladder(df.select(F.col(value).alias("_x")), "_x").select(
        F.col("_x").alias("_v"), (F.col("n_total") - F.col("n_before") - F.col("n")).alias("_above")
    )
    tagged = with_value_piece(df.withColumn("_v", F.col(value).cast("double")).withColumn(
        "_tie", F.col(tie).cast("double")), "_tie")
    numbered = split_row_number(tagged, ("_v",), [F.col(tie)], "_within", "_piece")
    return numbered.join(above, "_v").withColumn(name, F.col("_above") + F.col("_within")).drop(
        "_v", "_tie", "_above", "_within"
    )


def ordered_numbers(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The distinct values of some columns, none null, numbered from 0 in their order.

    Values are cut into ranges and sorted range by range; a value's number is its place in the
    range after the sizes of the ranges before it. The table is written, so that places stay.
    """
    n = pieces(df.sparkSession)
    values = df.select(*columns).dropna("any").distinct().repartitionByRange(n, *columns).sortWithinPartitions(*columns)
    placed = stored(values.withColumn("_at", F.monotonically_increasing_id()), "numbers")
    # The upper bits of the identifier name the range, the lower ones count within it.
    ranged = placed.withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    return ranged.join(before, "_range").select(*columns, (F.col("_at") + F.col("_before")).alias(name))

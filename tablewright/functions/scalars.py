"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

HASH_SPACE = 1 << 32


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key: str | Column, seed: int = 42) -> Column:
    """Number in [0, 2^32) that depends on the key and seed only, never on the partitioning."""
    text = F.concat(as_column(key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_fraction(key: str | Column, seed: int = 42) -> Column:
    return hash_bucket(key, seed) / F.lit(float(HASH_SPACE))


def ratio(a: str | Column, b: str | Column) -> Column:
    """Division that gives null, not an error, on a zero denominator."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def nine_digits(c: str | Column) -> Column:
    """Whole billionths, for ordering by a computed number so that noise in the last bits ties.

    A long is far cheaper than decimal rounding on the many candidate rows of a ranking.
    """
    return F.floor(as_column(c) * 1e9 + 0.5)


def half_even(c: str | Column, digits: int = 0) -> Column:
    return F.bround(as_column(c), digits)


def flag(condition: Column) -> Column:
    """0/1 with an unknown condition counted as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def finite_or_zero(c: str | Column) -> Column:
    c = as_column(c).cast("double")
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf"))) | c.isNull()
    return F.when(bad, F.lit(0.0)).otherwise(c)


def sum_present(df: DataFrame, names: list[str]) -> Column:
    """Row sum over those of `names` that exist; nulls count as zero."""
    here = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names if n in df.columns]
    return reduce(add, here) if here else F.lit(0.0)


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(
        as_column(a), as_column(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: str | Column) -> Column:
    return F.sqrt(dot(v, v))


def unit_vector(v: str | Column) -> Column:
    v = as_column(v)
    # The repeated length is computed once per row; inside a lambda it would be once per element.
    return F.zip_with(v, F.array_repeat(norm(v), F.size(v)), lambda x, n: F.coalesce(ratio(x, n), F.lit(0.0)))


def vector_mean(df: DataFrame, keys: list[str], vector: str, weight: str | None = None) -> DataFrame:
    """Weighted mean vector per key as `(keys, profile)`.

    The summarizer merges partial results before the shuffle, so a hot key sends one vector per
    task, whatever the number of its rows.
    """
    data = df.select(*keys, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"),
                     (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("_w"))
    means = data.groupBy(*keys).agg(Summarizer.mean(F.col("_v"), F.col("_w")).alias("_m"))
    return means.select(*keys, vector_to_array("_m").alias("profile"))

"""Schema audit of CSV files: the narrowest type that holds every value of a column.

Types form a lattice: whole numbers below decimal numbers, dates below moments, truth values by
themselves, text above all. One pass counts per column the values that each type cannot hold; the
counts of parts add up, so the pass is one aggregate. The scan itself then runs on a declared schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types from narrow to wide with the form of their values; the first that holds all values is taken.
FORMS = {
    "boolean": r"^(?i:true|false)$",
    "bigint": r"^[+-]?(0|[1-9][0-9]{0,18})$",  # no leading zeros: codes stay text
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$",
}
_CODE = r"^[+-]?0[0-9]"


def _misses(c: Column, kind: str) -> Column:
    """Whether a value is there and the type cannot hold it."""
    holds = c.rlike(FORMS[kind]) & c.try_cast(kind).isNotNull()
    if kind == "double":
        holds = holds & ~c.rlike(_CODE + r"+$")
    return c.isNotNull() & (c != "") & ~F.coalesce(holds, F.lit(False))


def audit(df: DataFrame) -> DataFrame:
    """`(column, kind, n_values, not_<type> ...)` of a frame of text columns; a column without values is text."""
    counts = df.agg(F.struct(*[
        F.struct(
            F.count_if(F.col(f"`{c}`").isNotNull() & (F.col(f"`{c}`") != "")).alias("n_values"),
            *[F.count_if(_misses(F.col(f"`{c}`"), kind)).alias(f"not_{kind}") for kind in FORMS],
        ).alias(f"c{i}") for i, c in enumerate(df.columns)
    ]).alias("s"))
    rows = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("s")[f"c{i}"].alias("v")) for i, c in enumerate(df.columns)
    ])).alias("r")).select("r.column", "r.v.*")
    kind = F.coalesce(*[F.when((F.col("n_values") > 0) & (F.col(f"not_{k}") == 0), k) for k in FORMS], F.lit("string"))
    return rows.select("column", kind.alias("kind"), "n_values", *[f"not_{k}" for k in FORMS])


def read_text_columns(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns of a CSV with a header as text; only the header is read before the query runs."""
    return spark.read.csv(path, header=True, sep=sep, escape='"', encoding="UTF-8")


def audited_types(spark: SparkSession, path: str, sep: str = ",", text: list[str] | None = None) -> dict[str, str]:
    """Type per column, by a pass over the file; columns in `text` stay text unseen. One short row per column reaches the driver."""
    df = read_text_columns(spark, path, sep)
    keep = set(text or [])
    found = {r["column"]: r["kind"] for r in audit(df.select(*[F.col(f"`{c}`") for c in df.columns if c not in keep])).collect()}
    return {c: found.get(c, "string") for c in df.columns}


def read_declared(spark: SparkSession, path: str, types: dict[str, str], sep: str = ",") -> DataFrame:
    """The CSV on a declared schema; a value that does not fit ends the query. Dates and moments are cast from their text."""
    late = {"date", "timestamp"}
    fields = [T.StructField(c, T.StringType() if kind in late else T.DataType.fromDDL(kind)) for c, kind in types.items()]
    df = spark.read.schema(T.StructType(fields)).csv(path, header=True, sep=sep, escape='"', encoding="UTF-8", mode="FAILFAST", enforceSchema=True)
    return df.withColumns({c: F.col(f"`{c}`").cast(kind) for c, kind in types.items() if kind in late})

"""Readers and writers for CSV and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import scratch_path
from tablewright.sources.audit import audited_types, read_declared
from tablewright.sources.schemas import BUILDING_TEXT, FILM_LINKS, GENOME_SCORES, GENOME_TAGS, RATINGS, TAGS

#: Spark's setting by which an execution ends with its shuffle files deleted.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with a header and a declared schema; nothing is scanned before the query runs.

    A value that does not fit its type ends the query: it never becomes null silently.
    """
    return spark.read.schema(schema).csv(path, header=True, sep=sep, escape='"', encoding="UTF-8", mode="FAILFAST")


def with_moment(df: DataFrame, epoch: str = "timestamp", name: str = "rated_at", year: bool = True) -> DataFrame:
    """Epoch seconds to a timestamp and its year."""
    df = df.withColumn(name, F.timestamp_seconds(epoch)).drop(epoch)
    return df.withColumn("year", F.year(name).cast("short")) if year else df


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return with_moment(read_csv(spark, path, RATINGS))


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    return with_moment(read_csv(spark, path, TAGS), name="tagged_at", year=False)


def read_genome_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, GENOME_SCORES)


def read_genome_tags(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, GENOME_TAGS)


def read_film_links(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, FILM_LINKS)


def read_buildings(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """Known text columns stay text, the others have audited (or given) types, the first unnamed column becomes `row_id`."""
    df = read_declared(spark, path, types or audited_types(spark, path, text=BUILDING_TEXT))
    return df.withColumnsRenamed({df.columns[0]: "row_id"})


def read_trimmed_header(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """Audited (or given) types, white space around column names dropped."""
    df = read_declared(spark, path, types or audited_types(spark, path))
    return df.toDF(*[c.strip() for c in df.columns])


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a full order: a top-n, not a global sort."""
    return df.orderBy(*order).limit(n)


def save_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> str:
    """Write Parquet with zstd. `mode='ignore'` skips a table that is already there.

    With `partition_by` rows are first gathered by that column; adaptive execution cuts values that
    are too large for one task, so a value has as many files as its size asks for.
    """
    writer = df
    if partition_by:
        writer = df.hint("rebalance", F.col(partition_by))
    out = writer.write.mode(mode).option("compression", "zstd")
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For results that several steps use: lineage ends at the table, counts come from its footers,
    and a lost executor costs a re-read, not a recomputation. The shuffle files of the write go with
    it: nothing reads them again, and the driver collects its garbage too seldom to free them.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        save_parquet(df, path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def dropped(table: DataFrame) -> None:
    """Deletes a table made by `stored` that no later step reads, itself or by what was made of it lazily."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(table.stored_path)
    path.getFileSystem(conf).delete(path, True)


def save_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").csv(path, header=True, sep=sep, escape='"')
    return path


def save_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path

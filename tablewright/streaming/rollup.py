"""Event rollups that grow by increments: mergeable sums per day and item.

Each batch of new files adds its own partial sums, kept under the number of the batch: a batch that is
run again after a crash replaces what it wrote, and the stream's checkpoint keeps batches from being
read twice. Counts, sums, sums of squares and extremes add up; who took part is kept as distinct
(day, item, person) rows in buckets. So parts may come in any order, and the merged table is that
of one pass over all events. Days older than the watermark can be merged into one part; an event
that comes later still is one more part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import pieces

SUMS = "day date, item string, n long, total double, squares double, first timestamp, last timestamp"
PEOPLE = "day date, item string, person long, bucket int"


def partial_sums(events: DataFrame, moment: str, item: str, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return events.groupBy(F.to_date(moment).alias("day"), F.col(item).cast("string").alias("item")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"),
        F.min(F.col(moment).cast("timestamp")).alias("first"), F.max(F.col(moment).cast("timestamp")).alias("last"),
    )


def people(events: DataFrame, moment: str, item: str, person: str) -> DataFrame:
    rows = events.select(F.to_date(moment).alias("day"), F.col(item).cast("string").alias("item"), F.col(person).cast("long").alias("person")).distinct()
    return rows.withColumn("bucket", F.pmod(F.xxhash64("person"), F.lit(pieces(events.sparkSession))).cast("int"))


def write_part(events: DataFrame, target: str, part: str, moment: str, item: str, value: str, person: str) -> None:
    """The partial state of some events under a name; written again, it is replaced."""
    partial_sums(events, moment, item, value).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/sums/part={part}")
    people(events, moment, item, person).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/people/part={part}")


def add_events(
    spark: SparkSession, source: str, schema: T.StructType, target: str, progress: str, moment: str, item: str, value: str, person: str
) -> None:
    """Take up the Parquet files of `source` that are new since the last run, then stop. `progress` is the stream's checkpoint."""

    def add(batch: DataFrame, number: int) -> None:
        write_part(batch, target, f"{number:012d}", moment, item, value, person)

    run = (
        spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(add)
        .option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    run.awaitTermination()


def _parts(spark: SparkSession, target: str, kind: str, fields: str) -> DataFrame:
    schema = T.StructType([*T.StructType.fromDDL(fields).fields, T.StructField("part", T.StringType())])
    return spark.read.schema(schema).parquet(f"{target}/{kind}")


def _merged(sums: DataFrame) -> DataFrame:
    return sums.groupBy("day", "item").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def rollup(spark: SparkSession, target: str) -> DataFrame:
    """`(day, item, n, mean_value, std_value, people, first, last)` of all events taken up so far."""
    sums = _merged(_parts(spark, target, "sums", SUMS))
    # A person of a day and item has one bucket, so buckets are counted apart and added.
    per_bucket = _parts(spark, target, "people", PEOPLE).select("day", "item", "bucket", "person").distinct().groupBy("day", "item", "bucket").agg(F.count("person").alias("c"))
    counted = per_bucket.groupBy("day", "item").agg(F.sum("c").alias("people"))
    mean = F.col("total") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0)))
    return sums.join(counted.withColumnsRenamed({"day": "_day", "item": "_item"}), F.col("day").eqNullSafe(F.col("_day")) & F.col("item").eqNullSafe(F.col("_item"))).select(
        "day", "item", "n", mean.alias("mean_value"), spread.alias("std_value"), "people", "first", "last"
    )


def close_days(spark: SparkSession, target: str, closed: str, delay_days: int = 2) -> str:
    """A copy of the state under `closed` in which all parts of days before the watermark are one part.

    The watermark is the latest event less `delay_days`. The old state stays as it is until the new
    one is complete; use the new folder from then on.
    """
    for kind, fields in (("sums", SUMS), ("people", PEOPLE)):
        parts = _parts(spark, target, kind, fields)
        mark = F.date_sub(_parts(spark, target, "sums", SUMS).agg(F.max("day")).scalar(), delay_days)
        old, new = parts.where(F.col("day") < mark), parts.where((F.col("day") >= mark) | F.col("day").isNull())
        one = _merged(old.drop("part")) if kind == "sums" else old.drop("part").distinct()
        kept = new.unionByName(one.withColumn("part", F.lit("closed")))
        kept.write.mode("overwrite").partitionBy("part").option("compression", "zstd").parquet(f"{closed}/{kind}")
    return closed

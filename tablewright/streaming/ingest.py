"""Out-of-core conversion of a growing folder of CSV files to Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.session import scratch_path


def ingest_csv(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: str | None = None,
    progress: str | None = None,
) -> str:
    """Convert the files not converted yet, then stop.

    Keep `progress` (the folder of the stream's checkpoint) between runs: a later run then
    reads only new files, and a run cut short goes on where it stopped.
    """
    rows = spark.readStream.schema(schema).option("header", True).option("escape", '"').csv(source)
    rows = prepare(rows) if prepare else rows
    sink = rows.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
    if partition_by:
        sink = sink.partitionBy(partition_by)
    run = (
        sink.option("checkpointLocation", progress or scratch_path(spark, "ingest"))
        .trigger(availableNow=True)
        .start(target)
    )
    run.awaitTermination()
    return target

"""Session factory and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "tablewright", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling on; extra settings override.

    Without `master` the cluster's own launcher settings are used.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor sees, named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tablewright-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing there is ever overwritten."""
    return f"{shared_folder(spark)}/tablewright/{label}-{uuid.uuid4().hex[:12]}"


def pieces(spark: SparkSession) -> int:
    """How many parts a hot group is split into: the session's shuffle parallelism."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))

"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Skewed shuffle joins are split even where that costs one more exchange: a hot parent key may carry a
# third of a fact table, and an unsplit task is worse than a further shuffle.
# The JVM compiles no method above 8,000 bytes; a stage that parses every cell of a row is one such method
# and would be interpreted. Above the limit Spark generates code operator by operator, in small methods.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}
# Joins and folds of facts: shuffles are cut finely and small parts are put together again, so that a task holds
# about so much of them however large the facts and whatever the session's number of shuffle partitions.
FACT_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "800",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
}


def tune(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Apply the run-time settings to a session that somebody else built."""
    for name, value in {**SETTINGS, **(more or {})}.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(app: str = "tallyforge", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder every executor can reach (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "tallyforge")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes inside remove their shuffle files when they end: nobody reads them again once the table is
    there, and Spark by itself keeps them until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def settler(spark: SparkSession):
    """A ``settle(name, frame)`` that cuts lineage with a Parquet table in the shared folder, so that a
    lost executor costs a re-read and never a recomputation of the chain."""

    def settle(name: str, frame: DataFrame) -> DataFrame:
        path = shared_dir(spark, name)
        with shuffles_removed(spark):
            frame.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    return settle

"""File-level sources and sinks: manifest, expectations, JSON summary."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig


# Files up to this size are read by Spark as one value; larger ones are streamed. The digest is the same.
WHOLE_BYTES = 256 << 20


def file_digests(spark: SparkSession, pattern: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """Path, SHA-256 and size of every matching file. A digest is over a file's bytes in order and so one
    task's work, but no task holds a large file: files above ``whole`` bytes are read in pieces."""
    found = spark.read.format("binaryFile").load(pattern)
    small = found.filter(F.col("length") <= whole).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    large = found.filter(F.col("length") > whole).select("path", F.col("length").alias("bytes"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for path in batch.column("path").to_pylist():
                uri = path if "://" in path or not path.startswith("file:") else path.removeprefix("file:")
                files, name = pyarrow.fs.FileSystem.from_uri(uri)
                sha = hashlib.sha256()
                with files.open_input_stream(name, compression=None) as source:
                    while piece := source.read(1 << 20):
                        sha.update(piece)
                digests.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(digests, pa.string()), batch.column("bytes")], names=["path", "sha256", "bytes"])

    return small.unionByName(large.mapInArrow(stream, "path string, sha256 string, bytes long"))


def source_manifest(spark: SparkSession, folder: str, raw: Mapping[str, DataFrame], config: RunConfig) -> DataFrame:
    """Per delivered file: path, digest, bytes, records of its table and the columns."""
    lines = []
    for t in config.tables:
        records = raw[t.name].agg(F.count(F.lit(1))).scalar()
        lines.append(
            file_digests(spark, f"{folder}/{t.name}.csv").select(
                F.lit(t.name).alias("table"),
                "path",
                "sha256",
                "bytes",
                records.alias("raw_rows"),
                F.array(*[F.lit(c) for c in t.columns]).alias("columns"),
            )
        )
    return reduce(DataFrame.unionByName, lines)


def read_expectations(spark: SparkSession, path: str, config: RunConfig) -> DataFrame:
    """Expected counts and totals from a JSON document as (measure, expected) rows."""
    groups = ["raw_rows", "clean_rows", "duplicate_rows_removed", "rejected_rows"]
    totals = ["completed_orders", "gross_sales", "discounts", "refunds", "net_sales", "aov", "sold_units", "returned_units"]
    counts = ", ".join(f"{t.name}: BIGINT" for t in config.tables)
    schema = ", ".join([f"{g} STRUCT<{counts}>" for g in groups] + [f"{t} STRING" for t in totals])
    # A group that the document does not have reads as NULL and states nothing.
    document = spark.read.option("multiLine", True).schema(schema).json(path)
    cells = [
        F.struct(F.lit(f"{g}:{t.name}").alias("measure"), F.col(g)[t.name].cast("string").alias("expected"))
        for g in groups
        for t in config.tables
    ]
    cells += [F.struct(F.lit(t).alias("measure"), F.col(t).alias("expected")) for t in totals]
    stated = document.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    return stated.filter(F.col("expected").isNotNull() | ~F.startswith("measure", F.lit("raw_rows:")))


def write_json(frame: DataFrame, path: str) -> None:
    """A nested one-row result as JSON, NULL members kept."""
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)

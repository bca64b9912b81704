"""Versions of an output folder: each load writes a folder of its own, and one small row, written last,
makes it the current one.

A load that dies leaves a folder nobody refers to; readers go on with the version before. ``prune``
removes what no kept version uses.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMIT = "version bigint, folder string, fingerprint string, committed_at timestamp, rows map<string, bigint>"


class NoVersionError(LookupError):
    """Nothing was committed under a folder yet."""


@dataclass(frozen=True)
class Version:
    """A committed load: its number, its folder under the root, what it was loaded from, rows by table."""

    number: int
    folder: str
    fingerprint: str
    rows: Mapping[str, int]


def _files(spark: SparkSession, path: str):
    """The file system and path objects of ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def begin() -> str:
    """A new folder for a load, relative to the root. Nothing is created."""
    return f"versions/{uuid.uuid4().hex}"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All commits under ``root``, one row each. A commit that died while writing has no row."""
    path = f"{root}/commits"
    files, at = _files(spark, path)
    if not files.exists(at):
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).option("recursiveFileLookup", True).json(path)


def current(spark: SparkSession, root: str) -> Version | None:
    """The version committed last. Of two that were committed at once under one number, the one whose
    folder sorts last, for every reader."""
    row = commits(spark, root).orderBy(F.desc("version"), F.desc("folder")).first()
    return Version(row["version"], row["folder"], row["fingerprint"], row["rows"] or {}) if row else None


def commit(spark: SparkSession, root: str, folder: str, *, fingerprint: str = "", rows: Mapping[str, int] | None = None) -> Version:
    """Make ``folder`` the current version. The row is one file that its task commits by a rename."""
    last = current(spark, root)
    number = last.number + 1 if last else 1
    counts = {k: int(v) for k, v in (rows or {}).items()}
    row = spark.createDataFrame([(number, folder, fingerprint, None, counts)], _COMMIT).withColumn("committed_at", F.current_timestamp())
    row.coalesce(1).write.json(f"{root}/commits/{number:010d}-{uuid.uuid4().hex}")
    return Version(number, folder, fingerprint, counts)


def read(spark: SparkSession, root: str, name: str, kind: str = "parquet") -> DataFrame:
    """Output ``name`` of the current version. A reader keeps its version while later ones are committed."""
    version = current(spark, root)
    if version is None:
        raise NoVersionError(f"no version under {root}")
    return getattr(spark.read, kind)(f"{root}/{version.folder}/{name}")


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders of all but the ``keep`` last versions, and of loads that died: their names. Not
    to be called while a load under ``root`` is running, whose folder has no commit either."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    kept = {r["folder"] for r in commits(spark, root).orderBy(F.desc("version"), F.desc("folder")).select("folder").limit(keep).collect()}
    files, at = _files(spark, f"{root}/versions")
    if not kept or not files.exists(at):
        return []
    gone = []
    for status in files.listStatus(at):
        folder = f"versions/{status.getPath().getName()}"
        if folder not in kept:
            files.delete(status.getPath(), True)
            gone.append(folder)
    return sorted(gone)

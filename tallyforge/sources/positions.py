"""Where a row lies: numbers for the rows of Parquet tables, without a shuffle or a window."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A number is the file's place among the sorted files, then the row's place in the file.
ROW_BITS = 38
_MOST_FILES = 1 << 62 - ROW_BITS


def _bare(path):
    """A path without its scheme: readers write one and the same file as file:/x and file:///x."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def with_position(frame: DataFrame, name: str = "position") -> DataFrame:
    """``frame``, a Parquet table as it was read, with a number for each row, from 0.

    The number follows from where the row lies, so it is unique whatever the rows hold, repeated rows
    included, and every evaluation and every retry gives it again. Rows of one file are numbered without
    gaps; each further file starts at the next multiple of 2^38. The table of file names that a table of
    several files needs has one row a file, as the driver's own listing has; Spark broadcasts it or not
    by its size. A name that is not in the listing is an error.
    """
    row = F.col("_metadata.row_index").alias(name)
    paths = sorted(frame.inputFiles())
    if len(paths) < 2:
        return frame.select("*", row)
    if len(paths) > _MOST_FILES:
        raise ValueError(f"{len(paths)} files are more than row numbers have room for")
    session = frame.sparkSession
    # From Arrow, so that Spark knows its size.
    listed = session.createDataFrame(pa.table({"_file": pa.array(range(len(paths)), pa.int64()), "_listed": paths}))
    files = listed.select("_file", _bare("_listed").alias("_listed"))
    placed = frame.select("*", row, _bare(F.col("_metadata.file_path")).alias("_path"))
    joined = placed.join(files, F.col("_path") == F.col("_listed"), "left")
    file = F.coalesce("_file", F.raise_error(F.concat(F.lit("file is not listed: "), F.col("_path"))).cast("bigint"))
    return joined.select(*frame.columns, (F.shiftleft(file, ROW_BITS) + F.col(name)).alias(name))

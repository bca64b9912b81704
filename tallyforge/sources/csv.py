"""CSV in and out: strict headers, every cell as text, logical record numbers, ragged records kept.

Files must carry exactly the expected header. Records whose field count differs are not dropped: they
come back flagged, so that the cleaning step can reject them with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import RunConfig
from .observed import write_counted
from .quoted import scan_blocks

_CORRUPT = "_corrupt_record"


class HeaderError(ValueError):
    """The header is not the expected one."""


class EmptyInputError(ValueError):
    """A file without data records."""


def check_header(spark: SparkSession, path: str, columns: list[str]) -> None:
    """Compare the header before any scan. Further files of a folder are checked while they are read."""
    found = spark.read.option("header", True).option("enforceSchema", False).csv(path).columns
    if found and found[0].startswith("\ufeff"):
        found = [found[0][1:], *found[1:]]
    if "source_row" in found and "source_row" not in columns:
        raise HeaderError("raw input must not already contain source_row")
    if found != columns:
        raise HeaderError(f"unexpected header in {path}: {found}")


_OPTIONS = {
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def scan(
    spark: SparkSession, path: str, columns: list[str], *, quoted_newlines: bool = True, whole_files: bool = False
) -> DataFrame:
    """All-text rows with ``source_row``, ``ragged`` and, for ragged rows, the untouched ``record``.

    Large files are split and read by many tasks, also where records span lines (``quoted.records``);
    ``quoted_newlines=False`` says that none does and saves the look at the quotes. ``whole_files`` gives every
    file to one task, for files whose lines end in a carriage return alone. Either way an empty line is no
    record, and a line of blanks is one (with the wrong field count).
    """
    check_header(spark, path, columns)
    schema = StructType([StructField(c, StringType()) for c in [*columns, _CORRUPT]])
    if whole_files:
        reader = spark.read.schema(schema).options(header=True, enforceSchema=False, multiLine=True, **_OPTIONS)
        return number_records(reader.csv(path), columns)
    fields = schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    if quoted_newlines:
        return scan_blocks(spark, path, columns, fields, _OPTIONS, _CORRUPT)
    lines = spark.read.text(path).filter(F.col("value") != "")
    parsed = lines.withColumn("_fields", F.from_csv("value", fields, _OPTIONS))
    rows = parsed.select(*[F.col("_fields")[c].alias(c) for c in [*columns, _CORRUPT]], "_metadata")
    return number_records(rows, columns, header=True)


def number_records(rows: DataFrame, columns: list[str], *, header: bool = False) -> DataFrame:
    """Number logical records in file order: the header is 1, the first record 2, and further files of
    the same table continue the count. With ``header`` the first row of every file is its header, which
    is left out.

    A row's place is its index inside its file block plus the records of all earlier blocks. Only one
    small row per block is gathered to build the offsets; the data itself is never sorted or moved.
    """
    placed = rows.select(
        *columns,
        F.col(_CORRUPT).isNotNull().alias("ragged"),
        F.col(_CORRUPT).alias("record"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    heads = F.when(F.col("_block") == 0, 1).otherwise(0) if header else F.lit(0)
    blocks = placed.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size"))
    ordered = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("_file").alias("_of"),
        F.col("_block").alias("_ob"),
        (F.col("_first") + heads).alias("_first"),
        F.coalesce(F.sum(F.col("_size") - heads).over(ordered), F.lit(0)).alias("_before"),
    )
    same = (F.col("_file") == F.col("_of")) & (F.col("_block") == F.col("_ob"))
    number = F.col("_id") - F.col("_first") + F.col("_before") + 2
    found = F.array(*[F.regexp_replace(F.coalesce(c, F.lit("")), "^\ufeff", "") for c in columns])
    expected = (found == F.array(*map(F.lit, columns))) & ~F.col("ragged")
    wrong = F.raise_error(F.concat(F.lit("unexpected header in "), "_file")).cast("boolean")
    is_record = F.when(F.col("_id") >= F.col("_first"), True).otherwise(F.when(expected, False).otherwise(wrong))
    joined = placed.join(offsets, same).filter(is_record)
    return joined.select(*columns, number.alias("source_row"), "ragged", "record")


def read_tables(
    spark: SparkSession, folder: str, config: RunConfig, *, quoted_newlines: bool = True
) -> dict[str, DataFrame]:
    """The raw tables of a folder with one ``<table>.csv`` (file or directory) each."""
    return {t.name: scan(spark, f"{folder}/{t.name}.csv", t.columns, quoted_newlines=quoted_newlines) for t in config.tables}


def stage(raw: dict[str, DataFrame], folder: str, spark: SparkSession, counts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Land raw tables as Parquet, so that later steps read numbered rows from splittable columns. Empty
    tables are an error. ``counts`` receives the rows of each table, as its write saw them."""
    staged = {}
    for name, frame in raw.items():
        rows = write_counted(frame, f"{folder}/{name}")["rows"]
        if not rows:
            raise EmptyInputError(f"{name} contains no data records")
        if counts is not None:
            counts[name] = rows
        staged[name] = spark.read.parquet(f"{folder}/{name}")
    return staged


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with a header, also for an empty result."""
    frame.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


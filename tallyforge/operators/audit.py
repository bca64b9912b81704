"""Reports over labelled frames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, TableSpec
from .clean import ACCEPTED, DUPLICATE, REJECTED


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def audit_rows(labelled: DataFrame) -> DataFrame:
    """Audit columns and the raw row as JSON with its NULLs kept."""
    body = F.to_json("raw", {"ignoreNullFields": "false"})
    return labelled.select(
        "source_table",
        "source_row",
        "business_key",
        "disposition",
        F.col("rejection_reason").alias("reason"),
        "retained_source_row",
        body.alias("raw_json"),
    )


def disposition_log(labelled: Mapping[str, DataFrame]) -> DataFrame:
    """All tables in one log."""
    return union_all([audit_rows(frame) for frame in labelled.values()])


def quality_summary(labelled: Mapping[str, DataFrame]) -> DataFrame:
    """One line per table, present even for an empty one, with the accounting identity."""
    return union_all([_quality_line(name, frame) for name, frame in labelled.items()])


def disposition_tallies() -> dict[str, Column]:
    """The counts of a quality line as aggregates over a labelled table."""
    is_ = lambda word: F.count_if(F.col("disposition") == word)
    return {"duplicate_rows_removed": is_(DUPLICATE), "rejected_rows": is_(REJECTED), "clean_rows": is_(ACCEPTED)}


def observed_quality(spark: SparkSession, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The quality summary from the counts that the writes of the labelled tables reported (``rows`` and
    ``disposition_tallies`` by table): no table is read."""
    number = lambda n: F.lit(int(n)).cast("bigint")
    lines = []
    for name, seen in counts.items():
        line = spark.range(1).select(
            number(seen["rows"]).alias("raw_rows"), *[number(seen[tally]).alias(tally) for tally in disposition_tallies()]
        )
        lines.append(_with_accounting(name, line))
    return union_all(lines)


def _quality_line(name: str, labelled: DataFrame) -> DataFrame:
    counted = labelled.agg(F.count(F.lit(1)).alias("raw_rows"), *[c.alias(n) for n, c in disposition_tallies().items()])
    return _with_accounting(name, counted)


def _with_accounting(name: str, counted: DataFrame) -> DataFrame:
    whole = F.col("duplicate_rows_removed") + F.col("rejected_rows") + F.col("clean_rows")
    return counted.select(
        F.lit(name).alias("table"), "*", (F.col("raw_rows") == whole).alias("accounting_passed")
    )


def rejected_rows(labelled: DataFrame, spec: TableSpec) -> DataFrame:
    """Untouched cells, row number and reasons of the rejected rows."""
    return _evidence(labelled, spec, REJECTED)


def duplicate_rows(labelled: DataFrame, spec: TableSpec) -> DataFrame:
    return _evidence(labelled, spec, DUPLICATE)


def _evidence(labelled: DataFrame, spec: TableSpec, disposition: str) -> DataFrame:
    return labelled.filter(F.col("disposition") == disposition).select(
        *[F.col("raw")[c].alias(c) for c in spec.columns],
        "source_row",
        "rejection_reason",
    )


def listing(log: DataFrame, disposition: str) -> DataFrame:
    """Ordered evidence listing out of the disposition log."""
    return log.filter(F.col("disposition") == disposition).orderBy("source_table", "source_row")


def profile(raw: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Whole-dataset column profile: filled, empty, padded, distinct, smallest and largest text.

    Values are first counted per (column, value), so that the shuffle carries distinct values and no
    expand over several distinct aggregates is needed.
    """
    cells = raw.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])).alias("cell")
    ).select("cell.*")
    trimmed = F.btrim("value")
    values = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    empty = F.col("value").isNull() | (trimmed == "")
    return values.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("empty"),
        F.coalesce(F.sum(F.when(F.col("value") != trimmed, F.col("n"))), F.lit(0)).alias("padded"),
        F.count("value").alias("distinct_values"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
    ).select(F.lit(table).alias("table"), "*")


def sentinels(log: DataFrame, keys: DataFrame) -> DataFrame:
    """How many listed keys carry each disposition (named-row checks)."""
    return (
        log.join(keys, "business_key", "left_semi")
        .groupBy("source_table", "disposition")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def staged_counts(raw: Mapping[str, DataFrame], config: RunConfig) -> DataFrame:
    return union_all(
        [
            raw[t.name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t.name).alias("table"), "rows")
            for t in config.tables
        ]
    )


def staging_guard(raw: Mapping[str, DataFrame], config: RunConfig) -> DataFrame:
    """Per table: rows, row numbers that are not whole numbers >= 1, and repeated row numbers."""
    lines = []
    for t in config.tables:
        number = F.col("source_row").cast("string").try_cast("bigint")
        per_number = raw[t.name].groupBy(number.alias("n")).agg(F.count(F.lit(1)).alias("rows"))
        lines.append(
            per_number.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("n").isNull() | (F.col("n") < 1), F.col("rows"))), F.lit(0)).alias("invalid_numbers"),
                F.count_if(F.col("rows") > 1).alias("repeated_numbers"),
            ).select(F.lit(t.name).alias("table"), "*", (F.col("rows") == 0).alias("empty"))
        )
    return union_all(lines)

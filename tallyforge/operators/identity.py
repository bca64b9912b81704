"""Duplicate records and conflicting keys, settled where the rows of a key lie together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import RunConfig, TableSpec
from .normalize import field_value, identity_parts, read_fields

# Keys are counted in so many buckets. Rows of a bucket with more than ``HOT_ROWS`` are never handed to one task.
BUCKETS, HOT_ROWS = 1 << 16, 1_000_000


def fingerprint(parts: list[Column]) -> tuple[Column, Column]:
    """128 bits over values and their NULL positions, as two bigints that hash aggregation can hold."""
    absent = [p.isNull() for p in parts]
    return F.xxhash64(F.lit(1), *absent, *parts), F.xxhash64(F.lit(2), *parts, *absent)


def with_identity(parsed: DataFrame, spec: TableSpec, config: RunConfig, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``business_key``, ``retained_source_row``, ``_copy`` and ``_key_conflict``.

    The first row of each distinct record survives, the rest are copies. A key is in conflict when more
    than one distinct record carries it; missing keys form one group. A record with a wrong field count
    is no copy of a well-formed one and puts no key in conflict: it is rejected for itself.

    Rows cross one shuffle, by key, and are settled where they lie. Keys of very many rows go another way, on
    which no task holds all rows of a key.
    """
    keyed = _with_key(parsed, F.col(spec.key))
    return _identified(keyed, hot_buckets(keyed, hot_rows), lambda rows: rows, spec, config)


def read_identified(
    raw: DataFrame, spec: TableSpec, config: RunConfig, hot: list[int], judge: Callable[[DataFrame], list] | None = None
) -> DataFrame:
    """``read_fields`` and ``with_identity`` of untouched rows: the shuffle carries raw cells, which are parsed
    after it. ``hot`` comes from ``hot_keys`` over the same keys. ``judge`` picks what is kept of a parsed row,
    so that what only its rules read is gone before rows of a key are sorted."""
    keyed = _with_key(raw, field_value(spec, spec.key, config))
    return _identified(keyed, hot, lambda rows: read_fields(rows, spec, config), spec, config, judge)


def hot_keys(raw: DataFrame, spec: TableSpec, config: RunConfig, hot_rows: int = HOT_ROWS) -> list[int]:
    """Buckets of keys with more than ``hot_rows`` rows; only the keys are read."""
    return hot_buckets(_with_key(raw, field_value(spec, spec.key, config)), hot_rows)


def hot_buckets(keyed: DataFrame, hot_rows: int) -> list[int]:
    counts = keyed.groupBy(_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return [r["bucket"] for r in counts.filter(F.col("n") > hot_rows).select("bucket").collect()]


def _with_key(rows: DataFrame, value: Column) -> DataFrame:
    return rows.withColumn("_key", F.coalesce(value, F.lit("")))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("_key"), F.lit(BUCKETS))


def _identified(keyed: DataFrame, hot: list[int], read, spec: TableSpec, config: RunConfig, judge=None) -> DataFrame:
    def marked(rows: DataFrame) -> DataFrame:
        rows = read(rows)
        parts = identity_parts(spec, config)
        ragged = F.col("ragged") if "ragged" in rows.columns else F.lit(False)
        first, second = fingerprint([*parts, ragged, *[F.col(c) for c in ("record",) if c in rows.columns]])
        marks = [F.nullif("_key", F.lit("")).alias("business_key"), first.alias("_f1"), second.alias("_f2"), ragged.alias("_ragged")]
        return rows.select(*(["_key", *judge(rows)] if judge else ["*"]), *marks)

    apart = _bucket().isin(hot)
    settled = _settled_in_place(marked((keyed.filter(~apart) if hot else keyed).repartition("_key")))
    if hot:
        settled = settled.unionByName(_settled_by_joins(marked(keyed.filter(apart))))
    return settled.withColumn("_copy", F.col("source_row") != F.col("retained_source_row")).drop("_key", "_f1", "_f2", "_ragged")


def _settled_in_place(rows: DataFrame) -> DataFrame:
    """Rows that lie by key: one sort serves the windows of records and of keys."""
    record = ["_key", "_f1", "_f2", "_ragged"]
    of_key, of_record = W.partitionBy("_key"), W.partitionBy(*record)
    whole = [F.when(~F.col("_ragged"), F.col(c)) for c in ("_f1", "_f2")]
    differs = F.lit(False)
    for part in whole:
        differs = differs | F.coalesce(F.min(part).over(of_key) != F.max(part).over(of_key), F.lit(False))
    return rows.sortWithinPartitions(*record).withColumns({
        "_key_conflict": differs & ~F.col("_ragged"),
        "retained_source_row": F.min("source_row").over(of_record),
    })


def _settled_by_joins(rows: DataFrame) -> DataFrame:
    """Records are settled on narrow rows (key, fingerprint, row number), partially aggregated, and joined back
    once, so that hot keys shrink before they meet and skewed partitions of the rows are split."""
    records = rows.groupBy("_key", "_f1", "_f2", "_ragged").agg(F.min("source_row").alias("retained_source_row"))
    # Counted over the retained row, so that both readers of the records ask for the same columns and share
    # one shuffle: otherwise all cells are parsed once more.
    distinct = F.count(F.when(~F.col("_ragged"), F.struct("retained_source_row")))
    per_key = records.groupBy("_key").agg((distinct > 1).alias("_key_conflict"))
    judged = records.join(per_key, "_key").select(
        "_f1", "_f2", "retained_source_row", (F.col("_key_conflict") & ~F.col("_ragged")).alias("_key_conflict")
    )
    return rows.join(judged, ["_f1", "_f2"], "left")

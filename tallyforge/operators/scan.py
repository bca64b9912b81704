"""Segmented prefix scans: running numbers over groups of any size, without a window over a group.

Rows are range-sorted by group and order, so a hot group is spread over as many parts as its rows fill.
Each part numbers its own rows as they stream by; what a part carries over is one small row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import settler

# A row's id is its part, then its index inside the part (how monotonically_increasing_id builds them).
_INDEX = 33


def _place(id_: str) -> tuple[Column, Column]:
    return F.shiftright(id_, _INDEX), F.col(id_).bitwiseAND(F.lit((1 << _INDEX) - 1))


def number_values(values: DataFrame, order: Sequence[Column], name: str, ranges: int | None = None) -> DataFrame:
    """``values`` with their number from 1 in ``order`` over the whole frame.

    A sample sort: ranges are cut by Spark's own sample, as many as the data need; each sorted part counts
    its rows, and a part's rows are shifted by the counts of the parts before it (a row for each part).
    """
    settle = settler(values.sparkSession)
    placed = values.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    # The ranges come from a sample, so they are written once and not drawn again.
    placed = settle("numbers", placed)
    part, index = _place("_id")
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = settle("offsets", sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn(name, index + F.col("_before") + 1).drop("_part", "_id", "_before")
    )


def _changes(batch: pa.RecordBatch, group: Sequence[str], last: list | None) -> np.ndarray:
    """Which rows begin a group, given the group of the row before the batch."""
    out = np.zeros(batch.num_rows, bool)
    for name in group:
        codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    out[0] = last is None or last != [batch.column(name)[0].as_py() for name in group]
    return out


def number_in_groups(rows: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """``rows`` with their number from 1 inside ``group`` in ``order`` (a total order gives fixed numbers).

    Parts hold equal shares of the rows whatever the groups are: a group with a third of all rows fills a
    third of the parts. Only the group that is open at a part's start carries anything over, so the carried
    counts are at most one row for each part and are broadcast. Null keys are a group of their own.
    """
    settle = settler(rows.sparkSession)
    own = rows.columns
    keys = [f"_key_{i}" for i in range(len(group))]
    keyed = rows.withColumns({k: F.col(g) for k, g in zip(keys, group)}).withColumn("_part", F.lit(0).cast("long"))
    sorted_ = keyed.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_part", F.spark_partition_id().cast("long"))
    schema = StructType([*sorted_.schema.fields, StructField("_at", LongType()), StructField("_inside", LongType())])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list | None = None
        at, begin = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.arange(at, at + batch.num_rows)
            start = np.maximum.accumulate(np.where(_changes(batch, keys, last), place, begin))
            columns = [*batch.columns, pa.array(place), pa.array(place - start + 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_at", "_inside"])
            last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
            at, begin = at + batch.num_rows, int(start[-1])

    placed = settle("running-numbers", sorted_.mapInArrow(numbered, schema))
    key = F.struct(*keys)
    ends = placed.groupBy("_part").agg(
        F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last"), F.max_by("_inside", "_at").alias("size")
    )
    # A part's last group counts for later parts that begin in that group.
    steps = ends.select(F.col("last").alias("key"), "_part", F.lit(1).alias("turn"), "size").unionByName(
        ends.select(F.col("first").alias("key"), "_part", F.lit(0).alias("turn"), F.lit(0).cast("long").alias("size"))
    )
    earlier = W.partitionBy("key").orderBy("_part", "turn").rowsBetween(W.unboundedPreceding, -1)
    carried = steps.withColumn("_before", F.sum("size").over(earlier)).filter((F.col("turn") == 0) & (F.col("_before") > 0))
    carried = carried.select(F.col("_part").alias("_cp"), F.col("key").alias("_ck"), "_before")
    same = (F.col("_part") == F.col("_cp")) & key.eqNullSafe(F.col("_ck"))
    return placed.join(F.broadcast(carried), same, "left").select(
        *own, (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(name)
    )

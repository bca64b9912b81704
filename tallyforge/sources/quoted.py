"""Records that span lines, read from files that many tasks share.

A task that starts in the middle of a file can't know whether it starts inside quotes. Every block of
a file therefore reports what it makes of either case: the state it ends in and the records it begins.
These reports are maps of two states, and maps compose: a prefix scan over one small row for each block
gives every block the state it starts in and the records before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settler

# What follows an opening quote up to the end of its field, a whole field, and the lines that end outside
# quotes when they begin outside (0) or inside (1). Quotes open only at the start of a field; a doubled quote
# stands for itself.
_REST = r'(?:[^"]|"")*"(?:[^",][^,]*)?'
_FIELD = rf'(?:[^",][^,]*|"{_REST})?'
_ENDS_OUTSIDE = (rf"\A{_FIELD}(?:,{_FIELD})*\z", rf"\A{_REST}(?:,{_FIELD})*\z")


def _turns(lines: pa.Array) -> list[np.ndarray]:
    """The states (1: inside quotes) that lines end in, entered outside and inside quotes."""
    raw = lines.cast(pa.binary())
    return [1 - pc.match_substring_regex(raw, p).to_numpy(zero_copy_only=False).astype(np.int32) for p in _ENDS_OUTSIDE]


def state_after(line: str, inside: bool) -> bool:
    """Whether a line ends inside quotes."""
    return bool(_turns(pa.array([line]))[int(inside)][0])


def _states(lines: pa.Array, quoted: np.ndarray, entered: list[int]) -> np.ndarray:
    """The states that lines which follow each other end in, a row for each state before the first. A line
    leaves the state, turns it round or sets it; what counts is the last one that sets it and the turns since."""
    out = np.arange(2, dtype=np.int32)[:, None].repeat(len(quoted), 1)
    if quoted.any():
        out[:, quoted] = _turns(lines.filter(pa.array(quoted)))
    sets, turns = out[0] == out[1], np.cumsum(out[0] > out[1])
    last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), -1))
    since = turns - np.where(last >= 0, turns[last], 0)
    begun = [np.where(last >= 0, out[0][last], s) for s in entered]
    return np.array([(b + since) % 2 for b in begun], np.int32)


# Of a line: where it stands, and for a block entered outside (0) and inside (1) quotes the state before
# and after it and the records begun so far.
_SCHEMA = "_file string, _block long, _at long, value string, b0 int, b1 int, a0 int, a1 int, n0 long, n1 long"


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place: tuple | None = None
    at, state, begun = 0, [0, 1], [0, 0]
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("_file").dictionary_encode(), batch.column("_block").to_numpy()
        codes = files.indices.to_numpy()
        edges = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), batch.num_rows]
        quoted = pc.match_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False)
        filled = pc.not_equal(batch.column("value"), "").to_numpy(zero_copy_only=False)
        index = np.empty(batch.num_rows, np.int64)
        before, after, records = (np.empty((2, batch.num_rows), t) for t in (np.int32, np.int32, np.int64))
        for lo, hi in zip(edges, edges[1:]):
            now = (files.dictionary[int(codes[lo])].as_py(), int(blocks[lo]))
            if now != place:
                place, at, state, begun = now, 0, [0, 1], [0, 0]
            index[lo:hi] = np.arange(at, at + hi - lo)
            at += hi - lo
            # Only lines with quotes change the state.
            after[:, lo:hi] = _states(batch.column("value").slice(lo, hi - lo), quoted[lo:hi], state)
            for s in (0, 1):
                before[s, lo], before[s, lo + 1 : hi] = state[s], after[s, lo : hi - 1]
                state[s] = int(after[s, hi - 1])
                records[s, lo:hi] = np.cumsum((before[s, lo:hi] == 0) & filled[lo:hi]) + begun[s]
                begun[s] = int(records[s, hi - 1])
        arrays = [pa.array(x) for x in (index, before[0], before[1], after[0], after[1], records[0], records[1])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_file"), batch.column("_block"), arrays[0], batch.column("value"), *arrays[1:]],
            names=["_file", "_block", "_at", "value", "b0", "b1", "a0", "a1", "n0", "n1"],
        )


_END = ["_file", "_block", "a0", "a1", "n0", "n1"]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last report of every block; a block's lines follow each other in one task."""
    last: pa.RecordBatch | None = None
    for batch in _reports(batches):
        both = batch.select(_END) if last is None else pa.concat_batches([last, batch.select(_END)])
        files, blocks = both.column("_file").dictionary_encode().indices.to_numpy(), both.column("_block").to_numpy()
        final = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1]))
        if len(final):
            yield both.take(pa.array(final))
        last = both.slice(both.num_rows - 1)
    if last is not None:
        yield last


def _entries(text: DataFrame) -> DataFrame:
    """For every block: the state it starts in, the records before it (headers counted), those of its own
    file, and the files up to it. One row a block comes together here, nothing of the data; the rows are
    stored, so that lines meet them where they are read and are not shuffled for it."""
    found = text.mapInArrow(_ends, "_file string, _block long, a0 int, a1 int, n0 long, n1 long")
    ends = settler(text.sparkSession)("blocks", found)
    own = W.partitionBy("_file").orderBy("_block")
    earlier = own.rowsBetween(W.unboundedPreceding, -1)
    swaps = F.when((F.col("a0") == 1) & (F.col("a1") == 0), 1).otherwise(0)
    # A block whose end does not depend on its start settles the state; later swaps turn it round.
    turned = ends.withColumns({"swaps": F.sum(swaps).over(own), "swaps_before": F.coalesce(F.sum(swaps).over(earlier), F.lit(0))})
    settled = F.last(F.when(F.col("a0") == F.col("a1"), F.struct("a0", "swaps")), ignorenulls=True).over(earlier)
    entered = turned.withColumn("settled", settled).withColumn(
        "inside", F.pmod(F.coalesce("settled.a0", F.lit(0)) + F.col("swaps_before") - F.coalesce("settled.swaps", F.lit(0)), F.lit(2))
    )
    counted = entered.withColumn("records", F.when(F.col("inside") == 1, F.col("n1")).otherwise(F.col("n0")))
    all_ = W.orderBy("_file", "_block")
    first = F.when(F.row_number().over(own) == 1, 1).otherwise(0)
    sums = counted.withColumn("first", first).select(
        F.col("_file").alias("_of"), F.col("_block").alias("_ob"), "inside",
        F.coalesce(F.sum("records").over(all_.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("_own_before"),
        F.sum("first").over(all_.rowsBetween(W.unboundedPreceding, 0)).alias("_files"),
    )
    return sums


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files, headers included, as text: _file, record, in_file (number in its file) and
    source_row (2 for the first data record, going on over the files).

    Lines end in a line feed, with or without a carriage return, also inside quotes, where they are read as
    line feeds. An empty line outside quotes is no record. Lines that are records by themselves, nearly all,
    stay where they are read; only those of records that span lines are shuffled. A quote that is never
    closed takes the rest of its file into one record, as it does for any reader.
    """
    text = spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    lines = text.mapInArrow(_reports, _SCHEMA)
    either = lambda x: F.when(F.col("inside") == 1, F.col(f"{x}1")).otherwise(F.col(f"{x}0"))
    same = (F.col("_file") == F.col("_of")) & (F.col("_block") == F.col("_ob"))
    placed = lines.join(F.broadcast(_entries(text)), same).select(
        "_file", "_block", "_at", "value", either("b").alias("before"), either("a").alias("after"),
        (either("n") + F.col("_own_before")).alias("in_file"), (either("n") + F.col("_before") - F.col("_files") + 1).alias("source_row"),
    )
    single = placed.filter((F.col("before") == 0) & (F.col("after") == 0) & (F.col("value") != ""))
    spread = placed.filter((F.col("before") == 1) | (F.col("after") == 1))
    lines_of = F.sort_array(F.collect_list(F.struct("_block", "_at", "value")))
    joined = spread.groupBy("_file", "in_file", "source_row").agg(F.array_join(F.transform(lines_of, lambda x: x["value"]), "\n").alias("record"))
    return single.select("_file", F.col("value").alias("record"), "in_file", "source_row").unionByName(joined)


def scan_blocks(spark: SparkSession, path: str, columns: Sequence[str], fields: str, options: dict, corrupt: str) -> DataFrame:
    """Parsed records with ``source_row``, ``ragged`` and ``record``; every file must begin with the header."""
    text = records(spark, path).withColumn(
        "record", F.when(F.col("in_file") == 1, F.regexp_replace("record", "^﻿", "")).otherwise(F.col("record"))
    )
    parsed = text.withColumn("_fields", F.from_csv("record", fields, options))
    bad = F.col(f"_fields.{corrupt}").isNotNull()
    found = F.array(*[F.coalesce(F.col("_fields")[c], F.lit("")) for c in columns])
    expected = (found == F.array(*map(F.lit, columns))) & ~bad
    wrong = F.raise_error(F.concat(F.lit("unexpected header in "), "_file")).cast("boolean")
    is_record = F.when(F.col("in_file") > 1, True).otherwise(F.when(expected, False).otherwise(wrong))
    return parsed.filter(is_record).select(
        *[F.col("_fields")[c].alias(c) for c in columns], "source_row", bad.alias("ragged"), F.col("_fields")[corrupt].alias("record")
    )

"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import BLANKS, settle, slices


@dataclass(frozen=True)
class Sizes:
    """Permitted lengths, and what a sequence of each costs: its tokens, a share for every sequence and a
    share for attention, which grows with the square."""

    lengths: tuple[int, ...] = (512, 1024, 2048, 4096)
    per_sequence: float = 64.0
    per_square: float = 1 / 32768

    def cost(self, length: int) -> float:
        return self.per_sequence + length + self.per_square * length * length


def pack_lengths(items: list[int], sizes: Sizes) -> tuple[list[int], list[int]]:
    """(bin of each item, length of each bin).

    Items come longest first; each goes to the open bin that it fills best. If none has room, a bin is
    opened with the size that costs least for each token it can still get: its own length, or less when
    not that much is left to pack. In the end every bin shrinks to the shortest permitted length that
    holds its contents.
    """
    lengths = sorted(sizes.lengths)
    order = sorted(range(len(items)), key=lambda i: (-items[i], i))
    left = sum(items)
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    used: list[int] = []
    bin_of = [0] * len(items)
    for i in order:
        size = items[i]
        k = bisect_left(room, (size, -1))
        if k < len(room):
            free, b = room.pop(k)
        else:
            fits = [c for c in lengths if c >= size]
            free = min(fits, key=lambda c: (sizes.cost(c) / min(c, max(left, 1)), c))
            b = len(used)
            used.append(0)
        bin_of[i] = b
        used[b] += size
        left -= size
        if free > size:
            insort(room, (free - size, b))
    return bin_of, [next(c for c in lengths if c >= u) for u in used]


def pack(
    docs: DataFrame, sizes: Sizes = Sizes(), *, id_col: str = "doc_id", text_col: str = "text", length: str | None = None,
    pieces_per_group: int = 20_000,
) -> DataFrame:
    """Pack documents into sequences: doc_id, piece, start, length, sequence, position, offset, capacity.

    The length of a document is its number of words, or the column ``length``. A document longer than the
    longest permitted sequence is cut there; ``start`` says where a piece begins in it. Pieces are dealt
    by a hash of what they are into groups of bounded size, and each group is packed by one task
    (``pack_lengths``); a group leaves at most a few sequences unfilled. The result depends on the rows
    alone, not on how they are stored.

    Every piece is in exactly one sequence, at ``offset`` after the pieces before it. A document without
    words is one piece of length 0 that needs no sequence (its sequence columns are null). Repeated rows
    are pieces of their own, counted before they are dealt; null ids are fine; an empty table gives an
    empty result. Other columns are left out, whatever their names.
    """
    words = F.size(F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), BLANKS), ""))
    measured = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"),
        (F.coalesce(F.col(length), F.lit(0)) if length else words).cast("long").alias("n"),
    )
    counted = settle(measured.groupBy("doc_id", "h", "n").agg(F.count("*").alias("copies")), "packing-lengths")
    longest = max(sizes.lengths)
    cut = F.when(F.col("n") > 0, F.ceil(F.col("n") / longest)).otherwise(1).cast("long")
    total = counted.agg(F.sum(F.when(F.col("n") > 0, F.col("copies") * cut))).first()[0] or 0
    pieces = (
        counted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)))
        .withColumn("start", F.col("piece") * longest)
        .withColumn("length", F.least(F.col("n") - F.col("start"), F.lit(longest)))
    )
    groups = slices(total, pieces_per_group)
    dealt = pieces.where("length > 0").withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "h", "copy", "piece"), F.lit(groups)).cast("long")
    )
    kind = docs.schema[id_col].dataType.simpleString()

    def fill(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("h", "ascending"), ("copy", "ascending"), ("piece", "ascending")])
        items = rows.column("length").to_pylist()
        bins, capacity = pack_lengths(items, sizes)
        seen, at = [0] * len(capacity), [0] * len(capacity)
        position, offset = [], []
        for b, size in zip(bins, items):
            position.append(seen[b]), offset.append(at[b])
            seen[b] += 1
            at[b] += size
        group = rows.column("group")[0].as_py()
        long = pa.int64()
        return pa.table({
            "doc_id": rows.column("doc_id"), "piece": rows.column("piece"), "start": rows.column("start"), "length": rows.column("length"),
            "sequence": pa.array([group << 32 | b for b in bins], long), "position": pa.array(position, long),
            "offset": pa.array(offset, long), "capacity": pa.array([capacity[b] for b in bins], long),
        })

    schema = f"doc_id {kind}, piece long, start long, length long, sequence long, position long, offset long, capacity long"
    packed = dealt.select("group", "doc_id", "h", "copy", "piece", "start", "length").groupBy("group").applyInArrow(fill, schema)
    none = F.lit(None).cast("long")
    empty = pieces.where("length <= 0").select(
        "doc_id", "piece", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"),
        none.alias("sequence"), none.alias("position"), none.alias("offset"), none.alias("capacity"),
    )
    return packed.unionByName(empty)

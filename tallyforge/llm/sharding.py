"""Minimax contiguous sharding of atomic groups (built-in functions only)."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import settle, slices

# A zoom splits each open stretch of the order into 2**ZOOM parts.
ZOOM = 8
LAST = 1 << 63


def _reach(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Where each greedy shard ends, as positions on the running size; stops early when a single
    stretch does not fit."""
    cuts, at = [], 0
    for _ in range(shards):
        k = bisect_right(ends, at + capacity) - 1
        at = max(at, ends[k]) if k >= 0 else at
        cuts.append(at)
    return cuts


def _smallest(ends: list[int], low: int, high: int, shards: int) -> int:
    """Binary search for the smallest capacity with which the greedy check covers everything."""
    while low < high:
        mid = (low + high) // 2
        if _reach(ends, mid, shards)[-1] == ends[-1]:
            high = mid
        else:
            low = mid + 1
    return low


def _cuts(groups: DataFrame, shards: int) -> list[int]:
    """The order keys at which shards 1, 2, ... begin.

    The driver sees at most a few thousand sums a round, whatever the number of groups: stretches of
    the order first, then finer ones only where a cut can still fall. The result is the exact optimum
    over single groups.
    """
    whole = groups.agg(F.sum("size").alias("total"), F.max("size").alias("most")).first()
    if not whole["total"]:
        return [LAST] * (shards - 1)
    total, low = int(whole["total"]), max(-(-int(whole["total"]) // shards), int(whole["most"]))

    def sums(shift: int, parents: list[int] | None) -> list[tuple[int, int, int, bool]]:
        part = groups
        if parents is not None:
            part = part.where(F.shiftright("h", shift + ZOOM).isin(parents))
        rows = (
            part.groupBy(F.shiftright("h", shift).alias("k"))
            .agg(F.sum("size").alias("size"), F.min("h").alias("first"), F.max("h").alias("last")).collect()
        )
        return [(int(r["first"]), int(r["k"]), int(r["size"]), r["first"] == r["last"]) for r in rows]

    shift = 64 - ZOOM
    # Each: first key, key of the stretch, size, whether it is a single group.
    stretches = [(*s, shift) for s in sorted(sums(shift, None))]
    while True:
        ends, at = [], 0
        for s in stretches:
            at += s[2]
            ends.append(at)
        capacity = _smallest(ends, low, total, shards)
        early = _reach(ends, low, shards)
        open_ = []
        for s, end in zip(stretches, ends):
            begin = end - s[2]
            if not s[3] and any(begin < (k + 1) * capacity and end > early[k] for k in range(shards)):
                open_.append(s)
        if not open_ or capacity == low:
            break
        shift = max(0, shift - ZOOM)
        finer: list = []
        for at_shift in {s[4] for s in open_}:
            # Stretches left alone earlier can open later; each is split from its own width.
            to = max(0, at_shift - ZOOM)
            finer += [(*s, to) for s in sums(to, [s[1] for s in open_ if s[4] == at_shift])]
        stretches = sorted([s for s in stretches if s not in set(open_)] + finer)
    firsts = [s[0] for s in stretches]
    out = []
    for cut in _reach(ends, capacity, shards)[:-1]:
        k = bisect_right(ends, cut)
        out.append(firsts[k] if k < len(firsts) else LAST)
    return out


def shard(
    docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text", rows_per_slice: int = 50_000
) -> DataFrame:
    """Deal rows into ``shards`` contiguous ranges of equal-text groups with the smallest possible
    largest shard, by bytes.

    Groups are ordered by a 64-bit hash of their text, so rows with equal texts stay together (texts
    that share a hash share a group, which keeps that promise). A null text is an empty one of size 1.
    Every row gets a shard and a ``slot``, gapless from 0 in its shard; repeated rows and null ids get
    slots of their own. An empty table gives an empty result; other columns are left out, whatever
    their names.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = settle(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "shard-base",
    )
    groups = settle(base.groupBy("h").agg(F.sum("size").alias("size"), F.count("*").alias("rows")), "shard-groups")
    cuts = _cuts(groups, shards)
    at = F.lit(0)
    for c in cuts:
        if c < LAST:
            at = at + F.when(F.col("h") >= F.lit(c), 1).otherwise(0)
    rows = groups.agg(F.sum("rows")).first()[0] or 0
    # Slots are numbered inside slices of even size, so that no group is numbered by one task.
    dealt = base.withColumn("shard", at.cast("int")).withColumn(
        "slice", F.pmod(F.xxhash64("rid"), F.lit(slices(rows, rows_per_slice))).cast("int")
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "slice").agg(F.count("*").alias("n"))
        .select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("shard", "slice").orderBy("h", "rid")
    return (
        dealt.withColumn("k", F.row_number().over(inside).cast("long") - 1)
        .join(offsets, ["shard", "slice"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("before") + F.col("k")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )

"""Removal of long byte strings that occur more than once anywhere in a corpus, by run-compressed
Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import shingles
from tallyforge.llm.common import settle, slices

# Bytes of a repeat, and of the shorter one that a passage of 50 words reaches (four letters and a blank
# each). The strings that say where equal windows meet have GRAM hundredths of that.
LENGTH, PASSAGE, GRAM = 400, 250, 32
# Bytes an index holds; sections of one anchor beyond which they are compared by counting instead; bytes of
# texts whose anchors are sought at once. Arrays of an index and of such a group fit the caches of a core.
INDEX_BYTES, HOT, GROUP = 1 << 17, 1000, 1 << 16
# Rows and stretches (a few dozen bytes each) that may be broadcast.
SENT = 500_000
# Positions of a stretch fit in PLACE bits of the packed hash.
PLACE = 20


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int = LENGTH) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text of ``length`` bytes or more: (index, keys, first windows, last windows).

    Every window of ``length`` bytes is named after the least hash among its strings of GRAM hundredths of
    that, the leftmost of equals. That depends on the window's bytes alone, so equal windows have equal keys wherever they
    are. Consecutive windows mostly share a string; each run of them is one entry.
    """
    out = []
    long_ = [(i, t) for i, t in enumerate(texts) if len(t) >= length]
    group: list[tuple[int, bytes]] = []
    size = 0
    for item in [*long_, None]:
        if group and (item is None or size + len(item[1]) >= GROUP):
            out += _anchors_of(group, length)
            group, size = [], 0
        if item is not None:
            group.append(item)
            size += len(item[1])
    return out


def _anchors_of(group: list[tuple[int, bytes]], length: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    buffer = np.frombuffer(b"".join(t for _, t in group), np.uint8)
    ends = np.cumsum([len(t) for _, t in group])
    gram = length * GRAM // 100
    width = length - gram + 1
    first, last, keys = [], [], []
    # A text longer than a stretch is taken in stretches that overlap by a window.
    step = (1 << PLACE) - length
    for at in range(0, len(buffer) - length + 1, step):
        part = buffer[at : at + step + length - 1]
        up, down = shingles._scale(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(shingles._LETTER[part] * up[: len(part)], dtype=np.uint64, out=sums[1:])
        n = len(part) - gram + 1
        hashes = shingles.mix((sums[gram:] - sums[:n]) * down[:n])
        mask = np.uint64((1 << PLACE) - 1)
        least = _sliding_least((hashes & ~mask) | np.arange(n, dtype=np.uint64), width)
        anchor = (least & mask).astype(np.int64)
        start = np.arange(len(anchor)) + at
        inside = start + length <= ends[np.searchsorted(ends, start, side="right")]
        label = np.where(inside, anchor, -1)
        change = np.flatnonzero(np.diff(label)) + 1
        a, b = np.concatenate(([0], change)), np.concatenate((change, [len(label)])) - 1
        keep = label[a] >= 0
        a, b = a[keep], b[keep]
        first.append(a + at), last.append(b + at), keys.append(hashes[label[a]])
    first, last, keys = map(np.concatenate, (first, last, keys))
    begin = ends - [len(t) for _, t in group]
    cut = np.searchsorted(first, np.concatenate((begin, ends[-1:])))
    return [
        (i, keys[a:b], first[a:b] - s, last[a:b] - s)
        for (i, _), s, a, b in zip(group, begin.tolist(), cut[:-1].tolist(), cut[1:].tolist())
    ]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array from seven symbols (below 512) at a time, then from as many ranks as fit a key: each round
    sorts only the suffixes that are still tied, within their places."""
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.int64) + 1, np.zeros(7, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key * 512 + padded[k : n + k]
    length, many = 7, 63 // (n + 2).bit_length()
    order = np.empty(n, np.int64)
    # Ranks are the first place of equal suffixes, from 1; 0 is past the end.
    rank = np.zeros(n + 1, np.int64)
    places = tied = np.arange(n)
    while True:
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        order[places] = tied
        equal = key[1:] == key[:-1]
        heads = np.flatnonzero(np.append(True, ~equal))
        rank[tied] = np.repeat(places[heads], np.diff(heads, append=len(key))) + 1
        more = np.append(equal, False) | np.append(False, equal)
        places, tied = places[more], tied[more]
        if not len(tied):
            return order
        key = rank[tied]
        for k in range(1, many):
            key = key * (n + 2) + rank[np.minimum(tied + k * length, n)]
        length *= many


def _common(symbols: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``x`` and ``y``, up to ``most``."""
    padded = np.concatenate((symbols, np.full(most + 64, 511, symbols.dtype)))
    out = np.zeros(len(x), np.int64)
    step = np.arange(32)
    for at in range(0, len(x), 1 << 14):
        live = np.arange(at, min(len(x), at + (1 << 14)))
        while len(live):
            differ = padded[(x[live] + out[live])[:, None] + step] != padded[(y[live] + out[live])[:, None] + step]
            any_ = differ.any(axis=1)
            out[live] += np.where(any_, differ.argmax(axis=1), 32)
            live = live[~any_ & (out[live] < most)]
    return out


def repeated_starts(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece the starts of ``length``-byte strings that also start elsewhere in ``pieces``.

    The Burrows-Wheeler transform of all pieces is cut into runs. Only the suffixes at run heads and run
    ends are sampled, with the length they share with the suffix before or after them; along the text
    every other suffix shares one byte less than the one to its left, so the matching statistics of all
    positions stream from the samples.
    """
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.full(int(ends[-1]) + 1, 256, np.int16)  # 256 ends a piece
    for p, e in zip(pieces, ends.tolist()):
        symbols[e - len(p) : e] = np.frombuffer(p, np.uint8)
    n = len(symbols)
    order = suffix_array(symbols)
    before = symbols[order - 1]
    starts = np.concatenate(([0], ends[:-1] + 1))
    # What precedes a piece is no symbol of the text: each piece begins a run of its own.
    is_start = np.zeros(n, bool)
    is_start[starts] = True
    own = is_start[order]
    breaks = np.flatnonzero((before[1:] != before[:-1]) | own[1:] | own[:-1]) + 1
    most = int(sizes.max()) + 1
    shared = _common(symbols, order[breaks - 1], order[breaks], most)

    def stream(sampled: np.ndarray, values: np.ndarray) -> np.ndarray:
        total = np.full(n, -1, np.int64)
        total[sampled] = sampled + values
        source = np.where(total >= 0, np.arange(n), 0)
        return total[np.maximum.accumulate(source)] - np.arange(n)

    # The first and the last suffix in order have no neighbour on one side.
    with_before = stream(np.append(order[breaks], order[0]), np.append(shared, 0))
    with_after = stream(np.append(order[breaks - 1], order[-1]), np.append(shared, 0))
    to_end = np.repeat(ends, sizes + 1) - np.arange(n)
    hit = (np.maximum(with_before, with_after) >= length) & (to_end >= length)
    return [np.flatnonzero(hit[s : s + k]) for s, k in zip(starts.tolist(), sizes.tolist())]


def runs(starts: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal stretches covered by strings of ``length`` at the sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    return [(int(g[0]), int(g[-1]) + length) for g in np.split(starts, cut)]


def _keyed(docs: DataFrame) -> DataFrame:
    """Name of a row by its id and text: rows with the same name are the same."""
    return docs.withColumns({
        "t1": F.xxhash64("body"), "t2": F.crc32(F.col("body").cast("binary")), "t3": F.octet_length("body").cast("long"),
    })


NAME = ["doc_id", "t1", "t2", "t3"]


def _same(x: DataFrame, y: DataFrame):
    out = x["doc_id"].eqNullSafe(y["doc_id"])
    for c in NAME[1:]:
        out = out & (x[c] == y[c])
    return out


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Stretches that repeated strings of ``length`` bytes cover of ``docs`` (doc_id, body, t1, t2, t3): the names of rows with lists of (from,
    to), in order and apart, only for rows that have any."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    name_fields = f"doc_id {kind}, t1 long, t2 long, t3 long"

    def sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in shingles.portions(batch.column("body")):
                found = anchors(texts, length)
                if found:
                    rows = np.concatenate([np.full(len(k), i) for i, k, _, _ in found]) + at
                    lo, hi = (np.concatenate([f[c] for f in found]) for c in (2, 3))
                    whole = [
                        xxhash.xxh3_64_intdigest(texts[i][a : b + length])
                        for i, _, first, last in found for a, b in zip(first.tolist(), last.tolist())
                    ]
                    part = batch.select(NAME).take(pa.array(rows))
                    keys = np.concatenate([k for _, k, _, _ in found]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in NAME), pa.array(keys), pa.array(np.array(whole, np.uint64).view(np.int64)),
                         pa.array(lo, pa.int64()), pa.array(hi + length, pa.int64())],
                        names=[*NAME, "key", "whole", "lo", "hi"],
                    )
                at += len(texts)

    all_ = settle(docs.mapInArrow(sections, f"{name_fields}, key long, whole long, lo long, hi long"), "repeat-anchors")
    # Windows of a key that occurs once are nowhere else.
    often = all_.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    multi = settle(all_.join(often, "key"), "repeat-sections")
    # A section that occurs twice as a whole is repeated as a whole.
    wholes = settle(
        multi.groupBy("key", "whole").agg(F.count("*").alias("n"), F.min(F.struct(*NAME, "lo", "hi")).alias("one")), "repeat-wholes"
    )
    full = multi.join(wholes.where("n > 1").select("key", "whole"), ["key", "whole"], "left_semi").select(
        *NAME, F.col("lo").alias("from"), F.col("hi").alias("to")
    )
    # The rest is compared among the different sections of a key.
    different = wholes.groupBy("key").agg(F.count("*").alias("different"), F.sum(F.col("one.hi") - F.col("one.lo")).alias("bytes")).where("different > 1")
    different = settle(different, "repeat-different")
    total = different.where(F.col("different") <= HOT).agg(F.sum("bytes")).first()[0] or 0
    indexes = slices(total, INDEX_BYTES)
    wanted = (
        wholes.join(different, "key")
        .select("one.*", "whole", F.when(F.col("different") > HOT, F.lit(-1)).otherwise(F.pmod(F.xxhash64("key"), F.lit(indexes))).cast("int").alias("place"), "key")
        .groupBy(*NAME).agg(F.collect_list(F.struct("key", "place", "lo", "hi")).alias("sections"))
    )
    wanted = settle(wanted, "repeat-wanted")
    texts = docs.join(wanted, _same(docs, wanted)).select(*[docs[c] for c in NAME], docs["body"], wanted["sections"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sections of a text by place; those of one index that overlap become one piece."""
        for batch in batches:
            for row, (text, sections) in enumerate(zip(batch.column("body").cast(pa.binary()), batch.column("sections").to_pylist())):
                raw, out = text.as_py(), []
                places: dict[int, list] = {}
                for s in sections:
                    if s["place"] < 0:
                        out.append((s["key"], -1, s["lo"], s["hi"], raw[s["lo"] : s["hi"]]))
                    else:
                        places.setdefault(s["place"], []).append((s["lo"], s["hi"]))
                for place, spans in places.items():
                    for lo, hi in merged(spans):
                        out.append((0, place, lo, hi, raw[lo:hi]))
                part = batch.select(NAME).take(pa.array([row] * len(out)))
                k, p, lo, hi, b = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in NAME), pa.array(k, pa.int64()), pa.array(p, pa.int32()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(b, pa.binary())],
                    names=[*NAME, "key", "place", "lo", "hi", "piece"],
                )

    pieces = settle(texts.mapInArrow(cut, f"{name_fields}, key long, place int, lo long, hi long, piece binary"), "repeat-pieces")

    def index(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        # Rows that are the same in name and place stand for one text.
        keys = list(zip(*(group.column(c).to_pylist() for c in (*NAME, "lo"))))
        first = list({k: i for i, k in reversed(list(enumerate(keys)))}.values())
        group = group.take(pa.array(sorted(first)))
        found = repeated_starts(group.column("piece").to_pylist(), length)
        row, lo, hi = [], [], []
        for i, (s, starts) in enumerate(zip(group.column("lo").to_pylist(), found)):
            for a, b in runs(starts, length):
                row.append(i), lo.append(s + a), hi.append(s + b)
        part = group.select(NAME).take(pa.array(row, pa.int64()))
        return pa.Table.from_arrays(
            [*(part.column(c) for c in NAME), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=[*NAME, "from", "to"]
        )

    indexed = pieces.where("place >= 0").groupBy("place").applyInArrow(index, f"{name_fields}, from long, to long")

    # Sections of a very frequent key: every window on its own, counted.
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (lo, piece) in enumerate(zip(batch.column("lo").to_pylist(), batch.column("piece").to_pylist())):
                names = [xxhash.xxh3_128_digest(piece[k : k + length]) for k in range(len(piece) - length + 1)]
                part = batch.select(NAME).take(pa.array([row] * len(names)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in NAME), pa.array(range(lo, lo + len(names)), pa.int64()), pa.array(names, pa.binary())],
                    names=[*NAME, "at", "window"],
                )

    windows = settle(pieces.where("place < 0").distinct().mapInArrow(each, f"{name_fields}, at long, window binary"), "repeat-windows")
    twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    counted = windows.join(twice, "window", "left_semi").select(*NAME, F.col("at").alias("from"), (F.col("at") + length).alias("to"))
    gathered = (
        full.unionByName(indexed).unionByName(counted).distinct()
        .groupBy(*NAME).agg(F.collect_list(F.struct("from", "to")).alias("stretches"))
    )

    def joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"from": a, "to": b} for a, b in merged((s["from"], s["to"]) for s in row)]
                for row in batch.column("stretches").to_pylist()
            ]
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in NAME), pa.array(found, kind)], names=[*NAME, "stretches"])

    return gathered.mapInArrow(joined_up, f"{name_fields}, stretches array<struct<from: long, to: long>>")


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping and touching stretches as one."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _sent(spans: DataFrame) -> DataFrame:
    """``spans`` for a join with the texts: few are sent to them, otherwise both are shuffled."""
    few = (spans.agg(F.sum(F.size("stretches") + 1)).first()[0] or 0) <= SENT
    return F.broadcast(spans) if few else spans


def remove(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", text: bool = False, own: bool = False, length: int = LENGTH,
    passage: int | None = None,
) -> DataFrame:
    """Cut every byte that a string of ``length`` bytes covers which also starts elsewhere in the table.

    Equal strings share an anchor (``anchors``), so the corpus is compared in parts that fit a task: keys
    that occur once are dropped, sections that occur twice as a whole are done, and the different
    sections of a key meet in one index (``repeated_starts``). Keys with very many different sections are
    not indexed; their windows are counted one by one. Strings are judged on the input.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``text`` what is left; with
    ``own`` the columns of ``docs`` instead, the text column holding what is left. With ``passage``, a length
    below ``length``, also passage_bytes and passage_spans: what strings of that length would remove. Strings
    of ``length`` are then sought only in texts with a stretch of the shorter ones that is as long, since all
    repeats of the longer lie in such stretches. What a cut leaves of a
    character that it splits is dropped from that text (the digest is over all bytes left).

    A null text is empty and stays null in ``own``; repeated rows and texts with other or null ids are
    repeats of each other like any others; an empty table gives an empty result. Without ``own`` other
    columns are left out, whatever their names.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    if own:
        columns = docs.columns
        packed = docs.select(F.struct(*[F.col(c) for c in columns if c != text_col]).alias("rest"), F.col(id_col).alias("doc_id"), body.alias("body"), F.col(text_col).isNull().alias("missing"))
    else:
        packed = docs.select(F.col(id_col).alias("doc_id"), body.alias("body"))
    named = _keyed(packed)
    bodies = named.select(*NAME, "body")
    if passage is None:
        spans = settle(find(bodies, length).withColumn("short", F.lit(None).cast("array<struct<from: long, to: long>>")), "repeat-stretches")
    else:
        shorter = settle(find(bodies, passage), "repeat-passages")
        long_ = _sent(shorter.where(F.exists("stretches", lambda s: s["to"] - s["from"] >= length)))
        longer = find(bodies.join(long_, _same(bodies, long_), "left_semi"), length).toDF(*[f"_{c}" for c in NAME], "long")
        same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.expr(" AND ".join(f"{c} = _{c}" for c in NAME[1:]))
        both = shorter.join(longer, same, "left")
        spans = settle(both.select(*NAME, F.col("long").alias("stretches"), F.col("stretches").alias("short")), "repeat-stretches")
    spans = _sent(spans)
    joined = named.join(spans, _same(named, spans), "left").select(
        *[named[c] for c in named.columns if c not in NAME[1:]], spans["stretches"], spans["short"]
    )
    carried = [c for c in joined.columns if c not in ("body", "stretches", "short")]
    fields = ", ".join(f"`{c}` {joined.schema[c].dataType.simpleString()}" for c in carried)
    with_text = text or own

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, stretches, short in zip(batch.column("body").cast(pa.binary()), batch.column("stretches"), batch.column("short")):
                raw, at, left = value.as_py() or b"", 0, []
                cuts = [(s["from"], s["to"]) for s in stretches.as_py() or ()]
                for lo, hi in cuts:
                    left.append(raw[at:lo])
                    at = hi
                left = b"".join([*left, raw[at:]])
                out.append((
                    len(raw), len(raw) - len(left), len(cuts), hashlib.sha256(left).hexdigest(),
                    left.decode("utf-8", "ignore") if with_text else None,
                    sum(s["to"] - s["from"] for s in short.as_py() or ()), len(short.as_py() or ()),
                ))
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "passage_bytes", "passage_spans"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *arrays], names=[*carried, *names])

    done = joined.mapInArrow(
        apply, f"{fields}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, passage_bytes long, passage_spans long"
    )
    if own:
        kept = F.when(~F.col("missing"), F.col("kept_text"))
        return done.select(*[kept.alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in columns])
    extra = ["kept_text"] * text + ["passage_bytes", "passage_spans"] * (passage is not None)
    out = done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *extra)
    return out.withColumnRenamed("kept_text", "text") if text else out

"""Collocations: stripes of next words for every prefix, merged entry by entry."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import shingles
from tallyforge.llm.common import settle

LONGEST, LEAST, BEST = 5, 100, 2000
# Bits of a filter of frequent names (a fixed 16 MB) and of one of its blocks; entries of stripes of words and
# of names that a task holds before it hands them on; slices of a stripe; salts of the first round of the ranking.
FILTER, BLOCK, HELD, NAMED, SLICES, SALTS = 27, 15, 1 << 17, 1 << 20, 256, 64

# What ends a piece, and what separates words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 9]] = True
_LOWER = bytes(shingles._LOWER)
_END = re.compile(rb"[.,;:!?\n-\r]")


@lru_cache(maxsize=4096)
def _tongue(lang: str) -> np.uint64:
    """What the name of a language adds to the hashes of its words."""
    raw = np.frombuffer(lang.encode() + b"\0", np.uint8)
    up, _ = shingles._scale(len(raw))
    return shingles.mix(np.sum(shingles._LETTER[raw] * up[: len(raw)], dtype=np.uint64, keepdims=True))[0]


def _words(texts: list[bytes], langs: list[str]):
    """Of all texts: the joined lower-case bytes, starts, ends and hashes of the words (a language has
    hashes of its own), the text that each stands in, and how many words follow it in its piece."""
    buffer = np.frombuffer((b"\n".join(texts) + b"\n").translate(_LOWER), np.uint8)
    gap = _GAPS[buffer]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    up, down = shingles._scale(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(shingles._LETTER[buffer] * up[: len(buffer)], dtype=np.uint64, out=sums[1:])
    place = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    salts = np.array([_tongue(lang) for lang in langs], np.uint64)
    hashes = shingles.mix(shingles.mix((sums[ends] - sums[starts]) * down[starts]) + salts[place])
    # A piece is a run of words with no end between them; words of two texts have the line break between.
    piece = np.cumsum(_ENDS[buffer])[starts]
    last = np.append(np.flatnonzero(piece[1:] != piece[:-1]), len(piece) - 1) if len(piece) else piece
    after = np.repeat(last, np.diff(last, prepend=-1)) - np.arange(len(piece))
    return buffer, starts, ends, hashes, place, after


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts (body) and languages of a batch, a bounded number of bytes at a time: a text longer than that is
    cut at the next end of a piece."""
    texts, langs, size, most = [], [], 0, shingles.PORTION // 4
    for value, lang in zip(batch.column("body").cast(pa.binary()), batch.column("lang").to_pylist()):
        text, at = value.as_py(), 0
        while at < len(text):
            end = _END.search(text, at + most) if len(text) - at > most else None
            part = text[at : end.end()] if end else text[at:]
            at += len(part)
            if texts and size + len(part) > most:
                yield texts, langs
                texts, langs, size = [], [], 0
            texts.append(part), langs.append("und" if lang is None else lang)
            size += len(part)
    if texts:
        yield texts, langs


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Names of phrases by the names of their prefixes and of their last words."""
    return shingles.mix(prefix * shingles._PLACE[0] + word)


def _names(hashes: np.ndarray, size: int) -> np.ndarray:
    """Names of all runs of ``size`` words."""
    out = hashes
    for k in range(1, size):
        out = _longer(out[:-1], hashes[k:])
    return out


def _passed(names: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = names >> np.uint64(64 - FILTER)
    return bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def _possible(hashes: np.ndarray, after: np.ndarray, size: int, filters: list[np.ndarray]) -> np.ndarray:
    """Which runs of ``size`` words lie in one piece and hold no part that is known to be rare: ``filters`` are
    those of 1, 2, ... words, and the longest parts they know are looked up."""
    n = len(hashes) - size + 1
    out = after[: max(0, n)] >= size - 1
    part = min(size, len(filters))
    if part and n > 0:
        good = _passed(_names(hashes, part), filters[part - 1])
        for k in range(size - part + 1):
            out &= good[k : k + n]
    return out


def stripes(batches: Iterator[pa.RecordBatch], sizes: Iterable[int], filters: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Stripes of the phrases of ``sizes`` words that may be frequent: for each prefix an associative counter
    of next words, merged in the task and cut into slices by the next word. Entries are told apart by their
    words; names only find equal ones among the words read at once."""
    held: dict[tuple[str, bytes], dict[bytes, int]] = {}
    entries = 0

    def flush() -> pa.RecordBatch:
        rows: list[tuple[str, bytes, int, list, list]] = []
        for (lang, prefix), stripe in held.items():
            slices: dict[int, tuple[list, list]] = {}
            for word, n in stripe.items():
                part = slices.setdefault(zlib.crc32(word) & SLICES - 1, ([], []))
                part[0].append(word), part[1].append(n)
            rows += [(lang, prefix, k, w, n) for k, (w, n) in slices.items()]
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.string(), pa.binary(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "prefix", "slice", "next", "counts"])

    for batch in batches:
        for texts, own in _portions(batch):
            buffer, starts, ends, hashes, place, after = _words(texts, own)
            raw, lo, hi = buffer.tobytes(), starts.tolist(), ends.tolist()
            for size in sizes:
                keep = np.flatnonzero(_possible(hashes, after, size, filters))
                if not len(keep):
                    continue
                _, first, counts = np.unique(_names(hashes, size)[keep], return_index=True, return_counts=True)
                first = keep[first]
                for i, n, t in zip(first.tolist(), counts.tolist(), place[first].tolist()):
                    prefix = b" ".join([raw[lo[k] : hi[k]] for k in range(i, i + size - 1)])
                    word = raw[lo[i + size - 1] : hi[i + size - 1]]
                    stripe = held.setdefault((own[t], prefix), {})
                    if word in stripe:
                        stripe[word] += n
                    else:
                        stripe[word] = n
                        entries += 1
            if entries >= HELD:
                yield flush()
                held.clear()
                entries = 0
    if held:
        yield flush()


def _merged(texts: DataFrame, sizes: list[int], named: list[DataFrame]) -> DataFrame:
    """Merged stripes of phrases of ``sizes`` words: lang, prefix, word, f.

    Slices of a stripe meet by language, prefix and slice, and are added up entry by entry, so the stripe
    of a hot prefix is spread and no stripe is ever one row. Stripes that were merged by names are put in
    words: ``named`` holds the words (lang, word, name) and then the entries of each size (``_entries``).
    """
    if named:
        word = named[0].select("lang", "word", F.col("name").alias("last"))
        known = named[0].select(F.col("word").alias("prefix"), F.col("name").alias("first"))
        out = []
        for entries in named[1:]:
            level = entries.join(known, "first").join(word, "last").select("lang", "prefix", "word", "f", "name")
            out.append(settle(level, "phrases-level"))
            known = out[-1].select(F.concat_ws(" ", "prefix", "word").alias("prefix"), F.col("name").alias("first"))
        return reduce(DataFrame.unionByName, out).drop("name")
    kind = "lang string, prefix binary, slice int, next array<binary>, counts array<long>"
    sliced = texts.mapInArrow(lambda batches: stripes(batches, sizes, []), kind)
    entry = F.explode(F.arrays_zip("next", "counts"))
    return (
        sliced.repartition("lang", "prefix", "slice")
        .select("lang", "prefix", "slice", entry.alias("e"))
        .groupBy("lang", "prefix", "slice", F.col("e.next").alias("word")).agg(F.sum("e.counts").alias("f"))
        .select("lang", F.col("prefix").cast("string").alias("prefix"), F.col("word").cast("string").alias("word"), "f")
    )


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (prefix, word, count) added up. Should two entries share a name they may stay in several rows,
    but never become one."""
    first, last, counts = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(_longer(first, last))
    first, last, counts = first[order], last[order], counts[order]
    at = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (last[1:] != last[:-1])))
    return first[at], last[at], np.add.reduceat(counts, at)


def _entries(texts: DataFrame, size: int, sent: Broadcast, least: int) -> DataFrame:
    """Merged stripes of the phrases of ``size`` words by names: the names of the prefix (first) and of the next
    word (last), f, and the name of the phrase; only entries that are counted ``least`` times or more.
    ``sent`` is the filter of phrases one word shorter."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def out(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)) for p in part], names=["first", "last", "n"])

        for batch in batches:
            for texts_, own in _portions(batch):
                _, _, _, hashes, _, after = _words(texts_, own)
                shorter = _names(hashes, size - 1)
                good = _passed(shorter, sent.value)
                keep = np.flatnonzero(good[:-1] & good[1:] & (after[: max(0, len(shorter) - 1)] >= size - 1))
                if not len(keep):
                    continue
                parts.append(_summed([(shorter[keep], hashes[keep + size - 1], np.ones(len(keep), np.int64))]))
                held += len(parts[-1][0])
                if held >= NAMED:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if held >= NAMED // 2:
                        yield out(parts[0])
                        parts, held = [], 0
        if parts:
            yield out(_summed(parts))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, last = (batch.column(c).to_numpy().view(np.uint64) for c in ("first", "last"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(_longer(first, last).view(np.int64))], names=["first", "last", "f", "name"]
            )

    kind = "first long, last long, {} long"
    counts = texts.mapInArrow(counted, kind.format("n")).groupBy("first", "last").agg(F.sum("n").alias("f"))
    return counts.where(F.col("f") >= least).mapInArrow(named, kind.format("f") + ", name long")


def _words_named(frequent: DataFrame) -> DataFrame:
    """Frequent words with their names: lang, word, f, name."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = [w.encode() for w in batch.column("word").to_pylist()]
                found = _words(texts, batch.column("lang").to_pylist())[3]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=["lang", "word", "f", "name"])

    return frequent.select("lang", "word", "f").mapInArrow(names, "lang string, word string, f long, name long")


def _places(named: DataFrame) -> DataFrame:
    return named.select(F.shiftrightunsigned("name", 64 - FILTER).alias("at"))


def _filter(places: DataFrame) -> Broadcast:
    """A bit for every place (``at``): 16 MB, whatever their number. The fuller it is the less it rules out,
    but nothing frequent is ever ruled out."""

    def block(group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << BLOCK - 3, np.uint8)
        at = group.column("at").to_numpy()
        inner = at & (1 << BLOCK) - 1
        np.bitwise_or.at(bits, inner >> 3, (1 << (inner & 7)).astype(np.uint8))
        return pa.table({"block": [int(at[0]) >> BLOCK], "bits": pa.array([bits.tobytes()], pa.binary())})

    found = places.distinct().withColumn("block", F.shiftright("at", BLOCK))
    out = np.zeros(1 << FILTER - 3, np.uint8)
    for row in found.groupBy("block").applyInArrow(block, "block long, bits binary").collect():
        begin = row["block"] << BLOCK - 3
        out[begin : begin + (1 << BLOCK - 3)] = np.frombuffer(row["bits"], np.uint8)
    return places.sparkSession.sparkContext.broadcast(out)


def mine(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, best: int = BEST,
    share: int = 100,
) -> DataFrame:
    """The best collocations of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z only) and split at ``.,;:!?`` and line ends into pieces, these at blanks into
    words. A phrase of 2 to ``longest`` words that occurs ``least`` times or more is a candidate with the
    score ``floor(1000 * a * n / (l * r))`` of its lowest cut (ties: the leftmost). Candidates inside a longer
    one with ``share`` percent of their count or more are dropped; as counts only fall with length, looking
    at phrases longer by one word is enough. The first ``best`` of a language by score, count and phrase stay.

    One structure answers all of it: the stripes, one for each prefix, count next words. Their entries are
    the phrases' counts (extensions), the entries of the level below are the totals of prefixes and rests,
    and the greatest entry of a stripe, or of the stripes that end alike, is the subsumption maximum. Words
    are counted as they are. Stripes of two, three and more words are read off the whole texts one length
    after the other and merged by names: an entry is the pair of the 64-bit hashes of its prefix and of its
    next word. A filter of a fixed size rules out entries with a part one word shorter that is not frequent.
    What is frequent gets its words by joins with the words and the phrases one word shorter, so texts of
    phrases never leave a task and each frequent phrase is written out once.

    A null text is empty and a null language ``und``; repeated rows count each; an empty table gives an empty
    result; equal scores and counts are ranked by the phrase's bytes; other columns are left out, whatever
    their names.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("body")).where("body IS NOT NULL AND body <> ''")
    if longest < 2:
        raise ValueError("longest must be 2 or more")
    single = settle(_merged(texts, [1], []), "phrases-words")
    totals = single.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = settle(_words_named(single.where(F.col("f") >= least)), "phrases-frequent")
    named, sizes = [frequent], list(range(2, longest + 1))
    for size in sizes:
        sent = _filter(_places(named[-1]))
        # The filter is part of the plan: it is settled here.
        named.append(settle(_entries(texts, size, sent, least), "phrases-entries"))
        sent.unpersist()
    several = _merged(texts, sizes, named)
    # Words hold no blank, so blanks tell the length.
    size = F.char_length("prefix") - F.char_length(F.replace("prefix", F.lit(" "), F.lit(""))) + 2
    candidates = several.withColumns({"size": size, "phrase": F.concat_ws(" ", "prefix", "word")})
    counts = frequent.select("lang", F.col("word").alias("phrase"), "f").unionByName(candidates.select("lang", "phrase", "f"))

    # Subsumption: the greatest extension of a phrase to the right is in its own stripe, the greatest to
    # the left among the stripes whose prefixes end in it.
    right = candidates.where("size > 2").select("lang", F.col("prefix").alias("phrase"), "f")
    left = candidates.where("size > 2").select("lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase"), "f")
    maxima = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("f").alias("greatest"))
    kept = candidates.join(maxima, ["lang", "phrase"], "left").where(
        F.col("greatest").isNull() | (F.lit(100) * F.col("greatest") < F.lit(share) * F.col("f"))
    )

    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k")).withColumn(
        "head", F.expr("substring_index(phrase, ' ', k)")
    ).withColumn("rest", F.expr("substring(phrase, char_length(head) + 2)"))
    joined = (
        cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = joined.select(
        "lang", "phrase", "a", "l", "r", "n", "k",
        F.call_function("div", F.lit(1000) * wide("a") * wide("n"), wide("l") * wide("r")).alias("score"),
    )
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select(
        "lang", "phrase", "x.*"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Each salt hands on its best, so the last sort of a language sees SALTS * best rows.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    some = lowest.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

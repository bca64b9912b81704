"""Spelling variants by asymmetric q-chunks: one word gives its disjoint chunks, the other its grams at the
same places, shifted by one where it is longer."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import settle

LEAST_LENGTH, LEAST_SEEN, TIMES, EVERY = 7, 2, 10, 31
# Different words a task holds before it hands its counts on, and rows of a key beyond which its words are
# told apart by smaller chunks.
HELD, HOT = 1 << 19, 256

# Letters of a word. U+00C0 to U+00FF are 0xC3 and a continuation byte in UTF-8.
_RUN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _shortened(run: bytes, h: int) -> bytes:
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY, least_length: int = LEAST_LENGTH) -> DataFrame:
    """All words of ``least_length`` code points or more with how often they occur: word, n.

    A run of letters loses the code point that its CRC-32 (of ``<doc_id>:<run>``) points at where ``every``
    divides that. Counts are added up in the task first, so a frequent word is one row a task.
    """
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("body")).where("body IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("body").cast(pa.binary())):
                start = zlib.crc32(f"{id_}:".encode())
                # A run has at most as many code points as bytes.
                for match in _blocks(text.as_py().translate(_LOWER)):
                    for run, n in Counter(r for r in match if len(r) >= least_length).items():
                        h = zlib.crc32(run, start)
                        if h % every == 0:
                            run = _shortened(run, h)
                        if len(run) - run.count(b"\xc3") >= least_length:
                            held[run] += n
                    if len(held) >= HELD:
                        yield flush()
                        held.clear()
        if held:
            yield flush()

    rows = texts.mapInArrow(counted, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).select(F.col("word").cast("string").alias("word"), "n")


def _blocks(text: bytes, most: int = 1 << 16) -> Iterator[list[bytes]]:
    """The runs of a text, ``most`` at a time."""
    out: list[bytes] = []
    for match in _RUN.finditer(text):
        out.append(match.group())
        if len(out) == most:
            yield out
            out = []
    yield out


def _chunks(rows: DataFrame, spans: Column) -> DataFrame:
    """``rows`` (word, size, longer, spans to cut) once for each of ``spans``: what stands before and after
    the span. A word that is one longer than its partner has one code point more inside the span."""
    cut = rows.withColumn("span", F.explode(spans)).withColumns({"lo": F.col("span.lo"), "hi": F.col("span.hi")})
    before = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    after = F.substring(F.col("word"), F.col("hi") + F.col("longer") + 1, F.col("size"))
    return cut.select("word", "n", "size", "longer", "lo", "hi", F.concat(before, after).alias("chunk"))


def _halves(lo: Column, hi: Column) -> list[Column]:
    middle = F.floor((lo + hi) / 2).cast("int")
    span = lambda a, b: F.struct(a.cast("int").alias("lo"), b.cast("int").alias("hi"))
    return [span(lo, middle), span(middle, hi)]


KEY = ["size", "lo", "hi", "chunk"]


def candidates(known: DataFrame, least_length: int = LEAST_LENGTH, hot: int = HOT) -> DataFrame:
    """Rows (word, n, longer, and the key size, lo, hi, chunk) in which every two words that differ by one
    edit share a key.

    A word of ``size`` code points gives disjoint chunks: its code points cut into spans, where a key holds
    all of the word but one span (``lo`` to ``hi``). One edit touches one span, or the border of two, so at
    least one key of the shorter word is untouched; the other word gives its grams at the same places, those
    after the edit shifted by one if it is longer (``longer`` = 1). Spans begin as quarters. Keys that more
    than ``hot`` rows share are cut further until they are rare or their span is one code point, where all
    rows differ in that place alone: no row is ever left out.
    """
    sized = known.select("word", "n", F.char_length("word").alias("length"))
    own = sized.select("word", "n", F.col("length").alias("size"), F.lit(0).alias("longer"))
    longer = sized.where(F.col("length") > least_length).select("word", "n", (F.col("length") - 1).alias("size"), F.lit(1).alias("longer"))
    rows = own.unionByName(longer)
    whole = F.array(*_halves(F.lit(0), F.col("size")))
    quarters = F.flatten(F.transform(whole, lambda s: F.array(*_halves(s["lo"], s["hi"]))))
    live, done = settle(_chunks(rows, quarters), "variants-chunks"), []
    while True:
        frequent = settle(live.where("hi - lo > 1").groupBy(*KEY).agg(F.count("*").alias("rows")).where(F.col("rows") > hot).select(*KEY), "variants-hot")
        if frequent.isEmpty():
            return _union([*done, live])
        done.append(live.join(frequent, KEY, "left_anti"))
        # The halves of a hot span are smaller chunks of the same words.
        again = live.join(frequent, KEY, "left_semi").select(
            "word", "n", "size", "longer", F.array(*_halves(F.col("lo"), F.col("hi"))).alias("halves")
        )
        live = settle(_chunks(again, F.col("halves")), "variants-chunks")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0].select("word", "n", "longer", *KEY)
    for frame in frames[1:]:
        out = out.unionByName(frame.select("word", "n", "longer", *KEY))
    return out


def near(known: DataFrame, least_length: int = LEAST_LENGTH, hot: int = HOT) -> DataFrame:
    """All pairs of different words one insertion, deletion or replacement apart, in both directions: word, n,
    other, other_n."""
    rows = candidates(known, least_length, hot)
    shorter = rows.where("longer = 0").select(*KEY, "word", "n")
    other = rows.select(*KEY, F.col("word").alias("other"), F.col("n").alias("other_n"), "longer")
    met = shorter.join(other, KEY).where("longer = 1 OR word < other").where(F.levenshtein("word", "other", 1) == 1)
    pairs = met.select("word", "n", "other", "other_n").distinct()
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.unionByName(turned)


def group(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_seen: int = LEAST_SEEN,
    times: int = TIMES, every: int = EVERY, hot: int = HOT,
) -> DataFrame:
    """The words of a corpus with the forms they are variants of: word, form, root, n, n_near, form_n.

    Words are runs of letters (A-Z in lower case) of ``least_length`` code points or more that occur
    ``least_seen`` times or more (``words``). Two are near if one edit parts them (``near``). The form of a word
    is its most frequent near word (ties: the least), if that is ``times`` as frequent or more; the root is
    where the forms lead. As counts grow ``times`` with every step, forms never lead back, and following
    twice as far in each round ends after a few rounds.

    A null text has no words; a null id reads as empty; repeated rows count each; an empty table gives an
    empty result; other columns are left out, whatever their names.
    """
    known = settle(words(docs, id_col, text_col, every, least_length).where(F.col("n") >= least_seen), "variants-words")
    # Of the near words, the most frequent and then the least: the least pair of (-n, word).
    links = settle(
        near(known, least_length, hot).groupBy("word").agg(
            F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("order"), F.col("other").alias("form"))).alias("best")
        ),
        "variants-near",
    )
    formed = known.join(links, "word", "left").withColumn("best_n", -F.col("best.order"))
    is_form = F.col("best_n") >= F.lit(times) * F.col("n")
    formed = settle(
        formed.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "variants-forms",
    )
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        # Those whose root has a form itself go on to that one's root.
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return formed.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

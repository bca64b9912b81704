"""Personal data: fixed patterns find seeds, the words around seeds become patterns, and patterns that hold
mostly known instances find further ones."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import settle

# The kinds in the order of their listing, and their shapes.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Of the bootstrap: different instances that a pattern needs, share of known ones among its instances (two
# unknown ones are added to each pattern), score an instance needs, and rounds.
SUPPORT, PRECISION, SCORE, ROUNDS = 8, 0.8, 0.8, 3
# Candidates: runs of these signs with a digit, of this many code points.
_CANDIDATE = re.compile(r"[A-Za-z0-9_@.+/()-]+")
_SHORTEST, _LONGEST = 5, 64
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_REACH = 80

_Spans = list[tuple[int, int, int]]


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def _luhn(digits: list[int]) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    turned = digits[::-1]
    return (sum(turned[0::2]) + sum(double[d] for d in turned[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one @, so each is tried once: time is linear even in runs without blanks."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        found = _DOMAIN.match(text, at + 1) if first < at else None
        if found:
            yield first, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base(text: str) -> _Spans:
    """(start, index of the kind, end) of all seeds, sorted. Matches that fail their kind's condition are
    dropped and their characters are not tried again."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def written(spans: _Spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: the two words before it, and the word before with the word after. Words
    are in lower case and without signs at their ends; those of another line do not count."""
    clean = lambda w: w.strip(".,;:!?\"'()[]{}<>|*#$%&=").lower()
    left = text[max(0, start - _REACH) : start].rpartition("\n")[2]
    right = text[end : end + _REACH].partition("\n")[0]
    before = [w for w in map(clean, _WORD.findall(left)[-4:]) if w][-2:]
    after = next((w for w in map(clean, _WORD.findall(right)[:2]) if w), "")
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after}")
    return out


def _others(text: str, taken: _Spans) -> Iterator[tuple[int, int]]:
    """Candidates: runs with a digit that touch no seed, without signs at their ends."""
    blocked = iter(sorted((a, b) for a, _, b in taken))
    now = next(blocked, None)
    for m in _CANDIDATE.finditer(text):
        lo, hi = m.start(), m.end()
        while now and now[1] <= lo:
            now = next(blocked, None)
        if now and now[0] < hi:
            continue
        # A longer run is no identifier; looking at it would cost its square.
        if not _SHORTEST <= hi - lo <= 2 * _LONGEST:
            continue
        run = m.group()
        lo, hi = lo + len(run) - len(run.lstrip("._+/()-@")), hi - len(run) + len(run.rstrip("._+/()-@"))
        if _SHORTEST <= hi - lo <= _LONGEST and any("0" <= c <= "9" for c in run):
            yield lo, hi


# Of a row: its name (id and text), what the seeds say, and all places with their patterns.
_PLACE = "struct<kind: int, lo: int, hi: int, value: string, patterns: array<string>>"


def _seeded(docs: DataFrame) -> DataFrame:
    """doc_id, body -> name, counts and digest of the seeds, and places of seeds and of candidates."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.struct([("kind", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
        for batch in batches:
            out = []
            for value in batch.column("body"):
                text = value.as_py()
                spans = base(text)
                places = []
                for lo, hi, k in [(a, b, k) for a, k, b in spans] + [(a, b, -1) for a, b in _others(text, spans)]:
                    found = _patterns(text, lo, hi)
                    if found or k >= 0:
                        places.append({"kind": k, "lo": lo, "hi": hi, "value": text[lo:hi].lower(), "patterns": found})
                counts = [sum(k == j for _, k, _ in spans) for j in range(len(KINDS))]
                out.append((hashlib.sha256(text.encode()).digest(), *counts, hashlib.sha256(written(spans).encode()).hexdigest(), places))
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.binary(), *[pa.int64()] * 4, pa.string(), pa.list_(place)]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], names=["doc_id", "name", *(f"n_{k}" for k in KINDS), "base_sha256", "places"]
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.mapInArrow(rows, f"doc_id {kind}, name binary, {counts}, base_sha256 string, places array<{_PLACE}>")


def trusted(edges: DataFrame, known: DataFrame, *, support: int = SUPPORT, precision: float = PRECISION, score: float = SCORE, rounds: int = ROUNDS) -> DataFrame:
    """Patterns that tell a kind: pattern, kind, trust.

    ``edges`` (pattern, value) is the graph of patterns and instances, ``known`` (value, kind) its seeds. In
    each round a pattern's trust in a kind is the sum of its instances' scores for that kind over the
    number of its different instances plus two; patterns with ``support`` known instances and a trust of
    ``precision`` score the instances they hold (one minus the product of distrust), and instances that
    reach ``score`` count as known, with that score, in the next round.
    """
    sizes = settle(edges.groupBy("pattern").agg(F.count("*").alias("instances")), "private-sizes")
    now = known.withColumn("score", F.lit(1.0))
    for turn in range(rounds):
        held = edges.join(now, "value").groupBy("pattern", "kind").agg(F.count("*").alias("support"), F.sum("score").alias("total"))
        good = held.where(F.col("support") >= support).join(sizes, "pattern")
        good = good.withColumn("trust", F.col("total") / (F.col("instances") + 2)).where(F.col("trust") >= precision)
        good = settle(good.select("pattern", "kind", "trust"), "private-patterns")
        if turn == rounds - 1 or good.isEmpty():
            return good
        # One minus the product of distrust, in logarithms; trust is below one.
        scored = (
            edges.join(known.select("value").distinct(), "value", "left_anti").join(good, "pattern")
            .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score"))
            .where(F.col("score") >= score)
        )
        # An instance is of the one kind that it is most surely of.
        best = scored.groupBy("value").agg(F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("b"))
        now = settle(known.withColumn("score", F.lit(1.0)).unionByName(best.select("value", "b.kind", "b.score")), "private-known")
    raise ValueError("rounds must be 1 or more")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Personal data of every row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found.

    Fixed patterns give the seeds (``base``): the counts and the digest are theirs. Around every seed and
    every other run with a digit the text gives lexical patterns (the two words before; the word before and
    the one after). ``trusted`` scores patterns and instances of the whole table against each other by joins
    and sums, and what stands at a trusted pattern without being a seed is found: ``spans`` holds seeds and
    found ones, ``n_found`` counts the latter. Rows are told apart by id and text, so repeated rows get
    the same result each; the patterns' hot words are added up before they are shuffled.

    A null text is empty; rows without spans have an empty ``spans`` and the digest of the empty string; an
    empty table gives an empty result; other columns are left out, whatever their names. Positions are in
    code points.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = settle(_seeded(docs.select(F.col(id_col).alias("doc_id"), body.alias("body"))), "private-rows")
    places = rows.select("doc_id", "name", F.explode("places").alias("p")).select("doc_id", "name", "p.*")
    edges = settle(places.select(F.explode("patterns").alias("pattern"), "value").distinct(), "private-edges")
    known = settle(places.where("kind >= 0").select("value", "kind").distinct(), "private-seeds")
    patterns = trusted(edges, known, **options)
    hits = (
        places.where("kind < 0").drop("kind").withColumn("pattern", F.explode("patterns")).join(patterns, "pattern")
        .groupBy("doc_id", "name", "lo", "hi").agg(F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"))
    )
    span = lambda lo, kind, hi: F.struct(lo.alias("lo"), kind.alias("kind"), hi.alias("hi"))
    found = hits.groupBy(F.col("doc_id").alias("id"), F.col("name").alias("of")).agg(
        F.collect_list(span(F.col("lo"), F.col("kind"), F.col("hi"))).alias("found")
    )
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("name") == F.col("of")), "left").withColumn(
        "found", F.coalesce("found", F.array().cast("array<struct<lo: int, kind: int, hi: int>>"))
    )
    seeds = F.transform(F.filter("places", lambda p: p["kind"] >= 0), lambda p: span(p["lo"], p["kind"], p["hi"]))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.sort_array(F.concat(seeds, F.col("found"))), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["lo"], s["hi"]))
    return joined.select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.array_join(text, ",").alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )

"""Byte-level BPE encoding and decoding by recursive DuckDB queries in every task."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Merges of a group of words run to a fixpoint. Positions are gapless in every word; a step joins each
# token and its right neighbour with the merge table, finds every word's leftmost pair of least rank and
# contracts it. Words without such a pair have settled and drop out.
ENCODE = """
WITH RECURSIVE state(word, pos, tok, step) AS (
    SELECT word, pos, tok, 0 FROM letters
    UNION ALL (
        WITH best AS (
            SELECT a.word, min(m.rank::BIGINT << 32 | a.pos) AS pair
            FROM state a
            JOIN state b ON b.word = a.word AND b.pos = a.pos + 1
            JOIN merges m ON m.left_tok = a.tok AND m.right_tok = b.tok
            GROUP BY a.word
        ), here AS (SELECT word, (pair >> 32)::INT AS rank, (pair & 4294967295)::INT AS pos FROM best)
        SELECT s.word, CASE WHEN s.pos > here.pos THEN s.pos - 1 ELSE s.pos END,
            CASE WHEN s.pos = here.pos THEN here.rank ELSE s.tok END, s.step + 1
        FROM state s JOIN here USING (word) WHERE s.pos <> here.pos + 1
    )
)
SELECT word, list(tok ORDER BY pos) AS ids
FROM state JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
GROUP BY word ORDER BY word
"""
DECODE = """
SELECT word, string_agg(t.bytes, '' ORDER BY i.pos) AS bytes
FROM tokens i JOIN vocabulary t ON t.id = i.tok GROUP BY word ORDER BY word
"""
# Words a query works on at once, words a task remembers, characters split at once.
WORDS, REMEMBERED, PIECE = 20_000, 500_000, 1 << 20
# Bytes of a word that the query takes as a whole, and rows it may make: a word of L bytes makes up to L * L / 2.
LONG, ROWS = 256, 3_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file: a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class Codec:
    """Encodes and decodes words; remembers a bounded number of both."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.letters = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.ids: dict[str, bytes] = {}
        self.texts: dict[bytes, bytes] = {}
        self.old_ids, self.old_texts = self.ids, self.texts
        # One thread and nothing spilled: Spark runs one of these in every task.
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = [
            (ranks[t[:i]], ranks[t[i:]], rank)
            for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        left, right, rank = zip(*merges) if merges else ((), (), ())
        pairs = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], np.array(rank, np.int64)[order]
        self.starts = {t[:i] for t in ranks for i in range(2, len(t))}
        self.big: list[str] = []
        int_ = lambda values: pa.array(values, pa.int32())
        self._load("merges", {"left_tok": int_(left), "right_tok": int_(right), "rank": int_(rank)})
        self._load("vocabulary", {"id": int_(list(ranks.values())), "bytes": pa.array([t.hex() for t in ranks])})

    def _load(self, name: str, columns: dict) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def learn(self, words: list[str]) -> None:
        """Remember the ids of ``words``, and the bytes those ids decode to."""
        for at in range(0, len(words), WORDS):
            part = words[at : at + WORDS]
            raw = [w.encode() for w in part]
            # A word that is a token is that token, whatever its merges would give.
            found = [[self.ranks[b]] if b in self.ranks else None for b in raw]
            open_ = [k for k, ids in enumerate(found) if ids is None]
            # What no token spans is never merged: long words fall apart there.
            cut = {k: self.cuts(raw[k]) for k in open_ if len(raw[k]) > LONG}
            pieces = list(dict.fromkeys(b for k in open_ for b in cut.get(k, (raw[k],))))
            coded = self.merged([b for b in pieces if len(b) <= LONG])
            coded |= {b: self.merged_long(b) for b in pieces if len(b) > LONG}
            for k in open_:
                parts = cut.get(k, (raw[k],))
                found[k] = coded[parts[0]] if len(parts) == 1 else np.concatenate([coded[b] for b in parts])
            self.big += [w for k, w in enumerate(part) if len(raw[k]) > LONG]
            packed = [np.asarray(ids, "<u4").tobytes() for ids in found]
            self.ids.update(zip(part, packed))
            new = [p for p in dict.fromkeys(packed) if p not in self.texts]
            if new:
                size = np.array([len(p) // 4 for p in new])
                word = np.repeat(np.arange(len(new), dtype=np.int32), size)
                pos = np.arange(len(word), dtype=np.int64)
                self._load("tokens", {"word": word, "pos": pos, "tok": np.frombuffer(b"".join(new), "<u4").astype(np.int32)})
                self.texts.update(zip(new, (bytes.fromhex(h) for _, h in self.con.execute(DECODE).fetchall()), strict=True))

    def merged(self, raw: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of words of up to LONG bytes by the recursive query, so many at once that its rows are bounded."""
        out: dict[bytes, list[int]] = {}
        group: list[bytes] = []
        rows = 0
        for b in [*raw, None]:
            if group and (b is None or rows + len(b) ** 2 // 2 > ROWS):
                word, pos, buffer = _positions(group)
                self._load("letters", {"word": word, "pos": pos, "tok": self.letters[buffer]})
                out.update((w, ids) for w, (_, ids) in zip(group, self.con.execute(ENCODE).fetchall(), strict=True))
                group, rows = [], 0
            if b is not None:
                group.append(b)
                rows += len(b) ** 2 // 2
        return out

    def cuts(self, raw: bytes) -> list[bytes]:
        """``raw`` cut at all places that no token of the vocabulary spans where it stands."""
        out, first, reach = [], 0, 0
        for i in range(len(raw)):
            if i and reach <= i:
                out.append(raw[first:i])
                first = i
            j = i + 2
            while j <= len(raw):
                part = raw[i:j]
                if part in self.ranks:
                    reach = max(reach, j)
                if part not in self.starts:
                    break
                j += 1
        return [*out, raw[first:]]

    def _rank(self, tokens: np.ndarray) -> np.ndarray:
        """Ranks of all neighbours; pairs that do not merge have the greatest number."""
        pairs = tokens[:-1] << 32 | tokens[1:]
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], np.iinfo(np.int64).max)

    def merged_long(self, raw: bytes) -> np.ndarray:
        """Ids of a long word that nothing cuts, in steps of one rank: the pairs of the least rank are contracted
        from the left, up to and with the first whose result makes a pair of a lesser rank with a neighbour."""
        tokens = self.letters[np.frombuffer(raw, np.uint8)].astype(np.int64)
        while len(tokens) > 1:
            ranks = self._rank(tokens)
            least = ranks.min()
            if least == np.iinfo(np.int64).max:
                break
            hits = np.flatnonzero(ranks == least)
            # Of hits that overlap in a row, every other one.
            begin = np.append(True, hits[1:] != hits[:-1] + 1)
            hits = hits[(np.arange(len(hits)) - np.maximum.accumulate(np.where(begin, np.arange(len(hits)), 0))) % 2 == 0]
            beside = np.append(False, hits[1:] == hits[:-1] + 2)
            left = np.where(beside, least, tokens[hits - 1])
            right = tokens[np.minimum(hits + 2, len(tokens) - 1)]
            lower = (hits > 0) & (self._rank(np.stack((left, np.full_like(left, least)), 1).ravel())[::2] < least)
            lower |= (hits + 2 < len(tokens)) & (self._rank(np.stack((np.full_like(right, least), right), 1).ravel())[::2] < least)
            if lower.any():
                hits = hits[: int(lower.argmax()) + 1]
            tokens[hits] = least
            tokens = np.delete(tokens, hits + 1)
        return tokens

    def prepare(self, words: Iterable[str]) -> None:
        """Have the ids of ``words`` at hand. What was not asked for since the memory was last full goes
        when it is full again; long words go at once."""
        for w in self.big:
            self.texts.pop(self.ids.pop(w, None), None)
        self.big = []
        need = []
        for w in dict.fromkeys(words):
            if w not in self.ids:
                packed = self.old_ids.get(w)
                if packed is None:
                    need.append(w)
                else:
                    self.ids[w] = packed
                    self.texts[packed] = self.old_texts[packed]
        if len(self.ids) + len(need) > REMEMBERED:
            own = {w: self.ids[w] for w in dict.fromkeys(words) if w in self.ids}
            self.old_ids, self.old_texts = self.ids, self.texts
            self.ids, self.texts = own, {p: self.old_texts[p] for p in own.values()}
        self.learn(need)

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each of the prepared words, little-endian."""
        return [self.ids[w] for w in words]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        return [self.texts[i] for i in ids]


def _positions(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, position, byte) of every byte."""
    size = np.array([len(b) for b in raw])
    word = np.repeat(np.arange(len(raw), dtype=np.int32), size)
    pos = (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
    return word, pos, np.frombuffer(b"".join(raw), np.uint8)


_CODECS: dict[str, Codec] = {}


def tokenize(
    docs: DataFrame, vocabulary: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", ids: bool = False
) -> DataFrame:
    """Encode every whole text and decode the ids again: doc_id, n_tokens, ids_sha256, decoded_sha256,
    and with ``ids`` the ids themselves.

    ``pattern`` splits a text into words; each distinct word of a batch that a task does not remember is
    encoded once, by a recursive query over its bytes and the merge table. The vocabulary (its size does
    not depend on the data) is read once and broadcast. Texts are split piece by piece of bounded size and
    hashed as they come, rows meet no other rows, and what a task remembers is bounded, so memory
    does not grow with the input.

    A null text is empty; empty texts have no tokens; null or repeated ids and repeated rows stay as they
    are; an empty table gives an empty result; other columns are left out, whatever their names.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    name = f"{vocabulary}:{hashlib.sha256(repr(sorted(ranks.value.items())).encode()).hexdigest()}"
    picked = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODECS.get(name)
        if codec is None:
            codec = _CODECS[name] = Codec(ranks.value)
        words = regex.compile(pattern)
        for batch in batches:
            out = []
            for texts in _portions(batch.column("text")):
                out += _coded(codec, words, texts, ids)
            columns = list(zip(*out)) if out else [(), (), (), ()]
            arrays = [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                arrays.append(pa.array(columns[3], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return picked.mapInArrow(run, schema)


def _portions(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a batch, a bounded number of characters at a time (a longer text comes alone)."""
    texts, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if texts and size + len(text) > PIECE:
            yield texts
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield texts


def _pieces(words: regex.Pattern, text: str) -> Iterator[list[str]]:
    """The words of a text, a bounded number at a time."""
    if len(text) <= PIECE:
        yield words.findall(text)
        return
    part: list[str] = []
    for m in words.finditer(text):
        part.append(m[0])
        if len(part) == PIECE // 4:
            yield part
            part = []
    yield part


def _coded(codec: Codec, words: regex.Pattern, texts: list[str], keep: bool) -> list[tuple]:
    """(number of tokens, digest of the ids, digest of the decoded bytes, ids) of each text."""
    split = [list(_pieces(words, t)) if len(t) <= PIECE else None for t in texts]
    codec.prepare([w for parts in split if parts for part in parts for w in part])  # one query for the words of all
    out = []
    for text, parts in zip(texts, split):
        n, sha_ids, sha_text, all_ids = 0, hashlib.sha256(), hashlib.sha256(), []
        for part in parts or _pieces(words, text):
            if not parts:
                codec.prepare(part)
            coded = codec.encode(part)
            joined = b"".join(coded)
            n += len(joined) // 4
            sha_ids.update(joined)
            sha_text.update(b"".join(codec.decode(coded)))
            if keep:
                all_ids.extend(np.frombuffer(joined, "<u4").astype(np.int32).tolist())
        out.append((n, sha_ids.hexdigest(), sha_text.hexdigest(), all_ids))
    return out

"""Word shingles of whole texts as sets of 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
# Bytes hashed at once; a longer text comes alone.
PORTION = 2 << 20

_MASK = (1 << 64) - 1
_random = np.random.Generator(np.random.PCG64(20240607))
_LETTER = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_random.integers(1, 1 << 63, dtype=np.uint64)) * 2 + 1 & _MASK
_PLACE = _random.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
# Of words for comparing wording: runs of ASCII letters, digits and anything beyond ASCII.
PLAIN = np.ones(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _scale(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    if len(_TABLES.get("up", ())) <= n:
        size = max(n, PORTION + 1024)
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _TABLES["up"], _TABLES["down"]


def portions(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a batch as UTF-8, a bounded number of bytes at a time; null is empty."""
    texts, size = [], 0
    for value in column.cast(pa.binary()):
        text = value.as_py() or b""
        if texts and size + len(text) > PORTION:
            yield texts
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield texts


def words_of(texts: list[bytes], blanks: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts joined by blanks: the joined bytes, where words start and end, a hash of each word in
    lower case (A-Z only), and the index of the first word of each text (and one past the last)."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = blanks[buffer]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    up, down = _scale(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_LETTER[_LOWER[buffer]] * up[: len(buffer)], dtype=np.uint64, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return buffer, starts, ends, hashes, np.searchsorted(starts, begin)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        total = total + hashes[k : k + n] * _PLACE[k]
    return mix(total)


def sets(texts: list[bytes], size: int = WORDS) -> list[np.ndarray]:
    """The set of shingles of each text, sorted. A text of fewer words has its whole sequence as one
    shingle, a text without words none. Shingles are told apart by 64-bit hashes."""
    _, _, _, hashes, first = words_of(texts)
    all_ = windows(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(all_[a : b - size + 1]))
        else:
            out.append(windows(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out

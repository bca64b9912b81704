"""Plain versions of the operators, to hold the Spark ones against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def metrics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def jaccard(rows):
    """(doc_id, n_shingles, component_id) of each (doc_id, text), all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    union = Union()
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                union.join(j, i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = union.find(i)
            least[r] = min(d, least.get(r, d))
    return [(d, len(s), least.get(union.find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def repeats(rows, length=400):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each (doc_id, text)."""
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raw):
        cut = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                cut[k : k + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cut) if not c)
        spans = len(re.findall(rb"\x01+", bytes(cut)))
        out.append((d, len(b), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return out


def smallest_capacity(sizes, shards):
    """Minimax over every contiguous cut, by dynamic programming."""
    best = [0] + [math.inf] * len(sizes)
    for _ in range(shards):
        after = [0] + [math.inf] * len(sizes)
        for j in range(1, len(sizes) + 1):
            total = 0
            for i in range(j, 0, -1):
                total += sizes[i - 1]
                after[j] = min(after[j], max(best[i - 1], total))
        best = [min(a, b) for a, b in zip(best, after)]
    return best[-1]


def near(rows, threshold):
    """(vec_id, n_links, component_id, kept) of each (vec_id, vector, label)."""
    def fine(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        return dot / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    links, union = Counter(), Union()
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            _, w, other = rows[j]
            if label == other and fine(v, label) and fine(w, other) and len(v) == len(w) and cosine(v, w) >= threshold:
                links[i] += 1
                links[j] += 1
                union.join(j, i)
    least = defaultdict(list)
    for i, (d, _, _) in enumerate(rows):
        least[union.find(i)].append(d)
    out = []
    for i, (d, _, _) in enumerate(rows):
        ids = [x for x in least[union.find(i)] if x is not None]
        c = min(ids) if ids else None
        out.append((d, links[i], c, c is None or d is None or d == c))
    return out

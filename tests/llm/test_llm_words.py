"""Collocations, personal data and spelling variants against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.llm import phrases, private, queries, variants

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, kind="doc_id long, text string, lang string"):
    return spark.createDataFrame(rows, kind)


# Collocations.


def plain_phrases(rows, least, best=2000, longest=5):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, seen in counts.items():
        many = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows_ = []
        for p, a in many.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(p, q) for q, b in many.items()):
                continue
            cuts = [(1000 * a * n[lang] // (seen[p[:k]] * seen[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_.append((" ".join(p), a, seen[p[:k]], seen[p[k:]], n[lang], score))
        rows_.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows_[:best])]
    return sorted(out)


def test_phrases_equal_a_plain_count(spark):
    rows = [
        (1, "New York, new york! New  York is\tbig. is big is big\nnew york is big", "en"),
        (1, "New York, new york! New  York is\tbig. is big is big\nnew york is big", "en"),
        (2, "a a a a a a a", None), (3, None, "en"), (4, "", "fr"), (5, "...,,,", "fr"), (None, "a a a b", "und"),
        (6, "x " * 4000 + "y", "de"), (7, "Ä ä é É Ä ä", "de"),
    ]
    for least, best in ((2, 2000), (3, 2)):
        got = phrases.mine(frame(spark, rows), least=least, best=best)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == plain_phrases([r[1:] for r in rows], least, best)


def test_phrases_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    got = sorted(map(tuple, phrases.mine(docs, least=20).collect()))
    assert len(got) > 50 and got == plain_phrases(rows, 20)


def test_phrases_equal_their_statement(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op11_phrase_collocations"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op11_phrase_collocations"](spark, SF).collect())) == want and want


def test_phrases_of_nothing_and_with_clashing_columns(spark):
    empty = frame(spark, [])
    assert phrases.mine(empty).collect() == []
    clash = frame(spark, [(1, "a b a b", "en")]).withColumns({c: F.lit("z") for c in ("phrase", "f", "prefix", "word", "n", "body", "slice")})
    assert sorted(map(tuple, phrases.mine(clash, least=2).collect())) == plain_phrases([("a b a b", "en")], 2)


def test_long_texts_are_cut_at_ends_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases.shingles, "PORTION", 50)
    text = "one two three four, " * 40
    batch = frame(spark, [(1, text, "en")]).select("lang", F.col("text").alias("body")).toArrow().to_batches()
    found = Counter()
    for out in phrases.stripes(iter(batch), [3], []):
        for r in out.to_pylist():
            for w, n in zip(r["next"], r["counts"]):
                found[r["prefix"] + b" " + w] += n
    assert found == {b"one two three": 40, b"two three four": 40}


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = [(" ".join(f"w{(i * k) % 97}" for i in range(400)), "en") for k in range(1, 12)]
    docs = frame(spark, [(1, t, lang) for t, lang in rows])
    want = plain_phrases(rows, 3)
    assert sorted(map(tuple, phrases.mine(docs, least=3).collect())) == want and want
    # A filter that is full rules nothing out, and the counts stay the same.
    monkeypatch.setattr(phrases, "_filter", lambda places: spark.sparkContext.broadcast(np.full(1 << phrases.FILTER - 3, 255, np.uint8)))
    assert sorted(map(tuple, phrases.mine(docs, least=3).collect())) == want


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**12
    row = spark.createDataFrame([(big, big + 1, big + 2, 10**13)], "a long, l long, r long, n long")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    got = row.select(F.call_function("div", F.lit(1000) * wide("a") * wide("n"), wide("l") * wide("r"))).first()[0]
    assert got == 1000 * big * 10**13 // ((big + 1) * (big + 2))


# Personal data.


def plain_base(text):
    """The contract's patterns as they stand, tried from left to right."""
    out = []
    for k, (kind, pattern) in enumerate({
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1]))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


signs = st.text(alphabet="a1.9@+-_ ()5\né%", max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.one_of(signs, st.lists(st.sampled_from([
    "a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4952935900253052", "4952 9359 0025-3052", "+1 (171) 555-2028",
    "+49", " ", ".", "-", "0001.02.3.255", "7", "é", "\n", "c_d@e.f",
]), max_size=12).map("".join)))
def test_seeds_equal_the_plain_patterns(text):
    assert private.base(text) == plain_base(text)


def test_runs_without_blanks_take_linear_time():
    for text in ("a" * 10**6, "1" * 10**6, "1." * 10**6, "a@" * 10**5, "+1" * 10**5, "1" * 10**6 + "@b.c"):
        private.base(text)
        assert list(private._others(text, [])) == []


def test_found_identifiers_stand_where_known_ones_stand(spark):
    rows = [(i, f"reach me by phone +1 (17{i % 10}) 555-20{i:02d} today", "en") for i in range(40)]
    rows += [(100, "reach me by phone 555-0199x3 today", "en"), (101, "the room by lot 555-0199x3 today", "en")]
    rows += [(200 + i, f"in the year {10000 + i} it rained", "en") for i in range(40)]
    rows += [(300, None, "en"), (301, "", None), (100, "reach me by phone 555-0199x3 today", "en"), (None, "ip 1.2.3.4", "en")]
    rows += [(400 + i, f"my number is 777-00{i:02d}x9 ok", "en") for i in range(12)]
    got = private.find(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    spans = defaultdict(list)
    for r in got:
        spans[r["doc_id"]].append((r["spans"], r["n_found"], r["n_phone"]))
    text = rows[40][1]
    at = text.index("555")
    assert spans[100] == [(f"phone:{at}:{at + 10}", 1, 0)] * 2
    assert all(spans[i][0][1:] == (0, 1) for i in range(40))
    assert all(spans[i] == [("", 0, 0)] for i in (101, *range(200, 240), 300, 301, *range(400, 412)))
    assert spans[None] == [("ip:3:10", 0, 0)]


def test_found_identifiers_make_patterns_of_their_own(spark):
    # Values beside "phone" are known by shape; the same callers' extensions also stand beside "extension",
    # where no seed ever stands: only the second round can find it.
    rows = [(i, f"call by phone +1 (17{i % 10}) 555-20{i:02d} now", "en") for i in range(60)]
    rows += [(100 + i, f"call by phone x555-7{i:02d} now", "en") for i in range(5)]
    rows += [(200 + i, f"dial the extension x555-7{i:02d} please", "en") for i in range(5)]
    rows += [(300, "dial the extension x555-999 please", "en")]
    rows_ = lambda rounds: {r["doc_id"]: r["n_found"] for r in private.find(frame(spark, rows), rounds=rounds, support=4, precision=0.6).collect()}
    first, second = rows_(1), rows_(3)
    assert all(first[100 + i] == second[100 + i] == 1 for i in range(5))
    assert first[300] == 0 and second[300] == 1


def test_personal_data_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = queries.QUERIES["op12_pii_bootstrap"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        spans = plain_base(texts[r["doc_id"]])
        text = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[1] == j for s in spans) for j in range(4)]
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_personal_data_of_nothing_and_with_clashing_columns(spark):
    assert private.find(frame(spark, [])).collect() == []
    clash = frame(spark, [(1, "a@b.c", "en")]).withColumns({c: F.lit("z") for c in ("name", "kind", "places", "found", "body", "pattern", "value")})
    assert [(r["spans"], r["n_email"]) for r in private.find(clash).collect()] == [("email:0:5", 1)]


# Spelling variants.


def plain_words(rows, least_length=7, least_seen=2, every=31):
    n = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= least_seen}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n, times=10):
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    near = {w: [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= times * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def in_order(frame_):
    return sorted(map(tuple, frame_.select(*NAMES).collect()), key=str)


def test_variants_equal_a_plain_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_variants(plain_words(rows))
    assert in_order(queries.QUERIES["op13_spelling_variants"](spark, SF)) == want
    assert sum(w[1] is not None for w in want) > 5 and len(want) > 100


@pytest.mark.parametrize("hot", [1, 3, 256])
def test_hot_chunks_are_cut_further(spark, hot):
    ends = ["ation", "atiön", "ations", "atons", "attion"]
    words = [f"{a}{b}{c}{e}" for a in "abc" for b in "abÿ" for c in "aé" for e in ends] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa"]
    known = {w: 1 + i % 7 * 40 for i, w in enumerate(dict.fromkeys(words)) if len(w) >= 7}
    frame_ = spark.createDataFrame(list(known.items()), "word string, n long")
    got = variants.near(frame_, hot=hot)
    pairs = sorted((r["word"], r["other"]) for r in got.collect())
    assert pairs == sorted((a, b) for a in known for b in known if one_edit(a, b)) and pairs


def test_chains_of_forms_end_at_their_root(spark):
    text = "abcdefgh " * 2 + "abcdefgx " * 20 + "abcdefyx " * 200 + "abcdezyx " * 2000
    rows = [(None, text, "en"), (2, None, "en"), (3, "", "en"), (3, "ABCDEFGH abc", "en")]
    want = plain_variants(plain_words([(r[0], r[1]) for r in rows]))
    clash = frame(spark, rows).withColumns({c: F.lit("z") for c in ("word", "n", "root", "id", "body", "size", "form")})
    assert in_order(variants.group(clash)) == want
    assert max(len({w[2] for w in want}), 1) < len(want)
    assert variants.group(frame(spark, [])).collect() == []


def test_a_long_run_and_every_run_shortened(spark):
    rows = [(7, "A" * 200_000 + " " + "éèàüößÿ " * 5, "en"), (7, "A" * 200_000, "en")]
    for every in (1, 31):
        want = plain_variants(plain_words([(r[0], r[1]) for r in rows], every=every))
        assert in_order(variants.group(frame(spark, rows), every=every)) == want


def test_only_frequent_phrases_of_any_length_are_handed_on(spark, monkeypatch):
    """Four words whose parts of three are frequent, but which occur once each, get no entry."""
    rows = [(i, "a b c. b c d", "en") for i in range(5)] + [(9, "a b c d", "en")]
    seen = []
    merged = phrases._merged
    monkeypatch.setattr(phrases, "_merged", lambda t, sizes, filters: seen.append(merged(t, sizes, filters)) or seen[-1])
    got = phrases.mine(frame(spark, rows), least=5)
    assert sorted(map(tuple, got.collect())) == plain_phrases([r[1:] for r in rows], 5)
    assert {r["prefix"] + " " + r["word"] for r in seen[-1].collect()} == {"a b", "b c", "c d", "a b c", "b c d"}


def test_each_frequent_phrase_is_written_out_once(spark, monkeypatch):
    """However many tasks read the texts, only frequent phrases are put in words, once each."""
    rows = [(i, "a b c d e. " + " ".join(f"w{i}x{k}" for k in range(20)), "en" if i % 2 else None) for i in range(40)]
    written = Counter()
    settle = phrases.settle

    def count(frame_, name):
        out = settle(frame_, name)
        written[name] += out.count()
        return out

    monkeypatch.setattr(phrases, "settle", count)
    want = plain_phrases([r[1:] for r in rows], 5)
    for parts in (1, 16):
        written.clear()
        assert sorted(map(tuple, phrases.mine(frame(spark, rows).repartition(parts), least=5).collect())) == want and want
        # Of two languages: ten phrases of two to five words each.
        assert written["phrases-entries"] == written["phrases-level"] == 20


def test_entries_of_one_name_are_not_added_up(monkeypatch):
    part = tuple(np.array(c, d) for c, d in (([1, 2, 1, 1], np.uint64), ([5, 5, 5, 6], np.uint64), ([1, 1, 2, 1], np.int64)))
    want = {(1, 5): 3, (2, 5): 1, (1, 6): 1}
    for longer in (phrases._longer, lambda first, last: np.zeros(len(first), np.uint64)):
        monkeypatch.setattr(phrases, "_longer", longer)
        got = Counter()
        for a, b, n in zip(*(c.tolist() for c in phrases._summed([part, part]))):
            got[a, b] += n
        assert got == {k: 2 * n for k, n in want.items()}

"""Operators on texts against plain versions, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import bpe, jaccard, licenses, packing, quality, repeats, sharding, shingles

SCHEMA = "doc_id LONG, text STRING, size STRING, s1 STRING, kept BOOLEAN"


def frame(spark, rows):
    """Rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, "x", "y", True) for d, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice(["ta", "ré", "mo", "ny", "KI", "lu", "zß"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, share):
    return " ".join(prose(rng, 1) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([3, 4, 5, 8, 30, 120, 400]))) for i in range(60)]
    base = prose(rng, 300)
    passage = prose(rng, 120)
    for i in range(60, 100):
        rows.append((i, edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05]))))
    for i in range(100, 130):
        rows.append((i, prose(rng, 60) + "\n" + passage + "\n" + prose(rng, rng.choice([20, 60]))))
    short = prose(rng, 24)
    rows += [(i, edited(rng, short, 0.03)) for i in range(130, 150)]
    rows += [(150, None), (151, ""), (152, " \t\n"), (None, base), (None, prose(rng, 50)), (7, rows[7][1]), (7, rows[7][1]), (8, prose(rng, 90))]
    rows += [(200, "la " * 600), (201, "la " * 600), (202, "Aa bb. " * 900), (203, prose(rng, 12_000))]
    return rows


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, ""), (None, "")]])
def test_trivial_tables(spark, rows):
    docs = frame(spark, rows)
    n = len(rows)
    assert sharding.shard(docs).count() == n
    assert quality.judge(docs).count() == n and quality.good_documents(docs).count() == 0
    assert repeats.remove(docs).count() == n and repeats.remove(docs, own=True).columns == docs.columns
    assert jaccard.join(docs).count() == n and jaccard.first_of_each(docs).count() == n
    assert packing.pack(docs).where("sequence IS NULL").count() == n
    assert licenses.scan(docs).count() == 0


def test_metrics_and_verdicts(spark, corpus):
    rows = corpus + [(300, "x y z x y z " * 20 + "#$%" * 9), (301, "a | b | c " * 40), (302, "ja! " * 30 + "\nline\nline\n \nline")]
    got = quality.judge(frame(spark, rows)).select("doc_id", *quality.METRICS, "base_failed", "kept", "size").collect()
    want = Counter()
    for d, t in rows:
        m = brute.metrics(t)
        want[(d, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert Counter((r.doc_id, *(r[m] for m in quality.METRICS), r.base_failed) for r in got) == want
    assert not any(r.base_failed and r.kept for r in got) and {r.size for r in got} == {"x"}
    assert {r.doc_id for r in got if r.kept} >= set(range(60, 100)) and 301 not in {r.doc_id for r in got if r.kept}


def test_long_windows_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(quality, "_MOST", 8)
    rows = [(1, "a b c d a b c e f a b c"), (2, "a b c")]
    assert [r.n_repeat_words for r in quality.measures(frame(spark, rows)).orderBy("doc_id").collect()] == [9, 0]


def test_quality_model_on_planted_votes():
    """Two kinds of junk that set off one rule each, and clean rows that seldom do."""
    rng = random.Random(3)
    rules = tuple(quality.Rule(str(j), "true", "false") for j in range(4))
    votes, kinds = Counter(), Counter()
    for _ in range(5000):
        kind = rng.choices(["good", "a", "b"], [8, 1, 1])[0]
        row = [1 if rng.random() < 0.95 else 0 for _ in rules]
        if kind != "good":
            row["ab".index(kind)] = -1
        votes[tuple(row)] += 1
        kinds[(tuple(row), kind)] += 1
    model = quality.fit(sorted(votes.items()), rules)
    assert 0.5 <= model.prior < 0.9
    right = sum(n for (row, kind), n in kinds.items() if (model.log_odds(row) >= 0) == (kind == "good"))
    assert right > 4990


def test_good_votes_outweigh_a_false_one():
    """Junk sets off three rules together; the fourth votes bad at random, on clean rows too."""
    rng = random.Random(3)
    rules = tuple(quality.Rule(str(j), "true", "false") for j in range(4))
    votes, kinds = Counter(), Counter()
    for _ in range(5000):
        junk = rng.random() < 0.15
        row = [-1 if rng.random() < 0.03 else 1]
        row += [(-1 if rng.random() < 0.9 else 0) if junk else (1 if rng.random() < 0.95 else 0) for _ in range(3)]
        votes[tuple(row)] += 1
        kinds[(tuple(row), junk)] += 1
    model = quality.fit(sorted(votes.items()), rules)
    assert model.log_odds((-1, 1, 1, 1)) > 0 > model.log_odds((1, -1, -1, -1)) and model.weight(1, 0) < 0
    assert sum(n for (row, junk), n in kinds.items() if (model.log_odds(row) < 0) == junk) > 4950


def test_fit_departs_from_its_start_and_leaves_clean_corpora_alone():
    """The start rejects every bad vote; the fit keeps rows with a vote that others do not confirm."""
    fine, lone, junk = (1,) * 8, (1, 1, -1, 1, 1, 1, 1, 1), (-1, -1, -1, 1, 1, 1, 1, 1)
    silent, silent_twice = (1, 1, 1, 1, 0, 1, 1, 1), (1, 1, 1, 1, 0, 0, 1, 1)
    for scale in (1, 1000, 10**6):
        seen = {fine: 7800 * scale, lone: 60 * scale, junk: 600 * scale, (1, 1, 1, 1, -1, 1, 1, 1): 150 * scale}
        model = quality.fit(sorted(seen.items()), quality.RULES)
        first = quality.start(quality.RULES)
        assert first.log_odds((1, 1, 1, 1, -1, 1, 1, 1)) < 0 < model.log_odds((1, 1, 1, 1, -1, 1, 1, 1))
        assert model.log_odds(junk) < 0 < model.log_odds(fine)
        clean = quality.fit(sorted({fine: 777 * scale, silent: 39 * scale, silent_twice: 14 * scale}.items()), quality.RULES)
        assert all(clean.log_odds(p) > 0 for p in (fine, silent, silent_twice))


def test_one_unconfirmed_rule_does_not_reject(spark):
    """Good texts of doubled lines stay beside junk that three rules see; all-must-pass would drop them."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    line = lambda: " ".join(word() for _ in range(12)) + "."
    good = [(i, "\n".join(line() for _ in range(9))) for i in range(300)]
    junk = [(1000 + i, " ".join(word() + "***" for _ in range(90))) for i in range(40)]
    doubled = [(2000 + i, "\n".join([line() for _ in range(7)] + ["a b"] * 9)) for i in range(10)]
    got = {r.doc_id: r for r in quality.judge(frame(spark, good + junk + doubled)).collect()}
    assert all(2 * r.n_dup_lines >= r.n_lines and not r.base_failed for i, r in got.items() if i >= 2000)
    assert {i for i, r in got.items() if not r.kept} == {i for i, _ in junk}


def test_word_kinds_match_plain_loops(spark):
    texts = ["", "a", "a| |b", "Straße, été. x.. y! 1a a1 | $", "x" * 50_000 + " #" + "y" * 50_000, "\x0ba\x0cb\x1cc", "***\n***", "a,b c,"]
    got = quality.measures(frame(spark, list(enumerate(texts)))).collect()
    plain = lambda w: (w[:-1] if w[-1] in ".,;:?" else w).isalpha()
    for r in got:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", texts[r.doc_id]) if w]
        assert (r.n_symbol_words, r.n_plain_words) == (sum(any(c in "#*$%&|<>" for c in w) for w in words), sum(map(plain, words)))


def test_junk_labels(spark):
    """Held against the labels of a small table: junk goes and good documents that pass the base rule stay."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r["quality"]: r["kept"] for r in got.collect()}
    assert kept[1] > 0.99 and kept[0] < 0.1


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_minimax(spark, corpus, shards):
    rows = corpus + [(1000 + i, "big " * 400) for i in range(40)]
    got = sharding.shard(frame(spark, rows), shards, rows_per_slice=7).collect()
    text_of = {zlib.crc32((t or "").encode()): t or "" for _, t in rows}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    by_shard, shard_of = defaultdict(list), defaultdict(set)
    for r in got:
        by_shard[r.shard].append(r)
        shard_of[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values()) and set(by_shard) <= set(range(shards))
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    hashes = {r.h: r.text for r in spark.createDataFrame([(t,) for t in text_of.values()], "text STRING").selectExpr("xxhash64(text) h", "text").collect()}
    total = Counter()
    for r in got:
        total[text_of[r.text_crc32]] += r.size
    order = [total[hashes[h]] for h in sorted(hashes)]
    assert max(sum(r.size for r in rs) for rs in by_shard.values()) == brute.smallest_capacity(order, shards)


def test_jaccard_components(spark, corpus):
    got = jaccard.join(frame(spark, corpus))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute.jaccard(corpus)))


def test_jaccard_large_groups_are_split(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 6)
    monkeypatch.setattr(jaccard, "HOT_KEY", 4)
    got = jaccard.join(frame(spark, corpus))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute.jaccard(corpus)))


def test_linked_sets_share_a_key():
    """Routing at the threshold: exact for small sets, and no miss in many tries for larger ones."""
    rng = np.random.default_rng(1)
    for size, tries in ((1, 20), (4, 200), (7, 300), (20, 300), (72, 300), (97, 200), (200, 300), (900, 100)):
        for _ in range(tries):
            all_ = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            common = -(-3 * size // 4)
            side = rng.integers(0, 2, size - common).astype(bool)
            a, b = np.sort(np.concatenate((all_[:common], all_[common:][side]))), np.sort(np.concatenate((all_[:common], all_[common:][~side])))
            assert len(np.intersect1d(jaccard.routing_keys(a), jaccard.routing_keys(b))), size


def test_sets_tied_by_hot_keys_only_meet(spark):
    """Thousands of sets of one template with more than 96 shingles, and sets of fewer that link with them:
    all keys they share are hot."""
    rng = np.random.default_rng(11)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    base = draw(95)
    for short in (76, 80):
        sets_ = [np.unique(np.concatenate([base, draw(5)])) for _ in range(2500)]
        sets_.append(np.sort(rng.permutation(base)[:short]))
        assert len(sets_[-1]) <= 96 < len(sets_[0]) and any(jaccard._linked(sets_[-1], s) for s in sets_[:-1])
        rows = [(i, [int(k) for k in jaccard.routing_keys(s).view(np.int64)]) for i, s in enumerate(sets_)]
        found = {r.node: r.root for r in jaccard.candidates(spark.createDataFrame(rows, "s1 LONG, keys ARRAY<LONG>")).collect()}
        assert len(found) == 2501 and set(found.values()) == {0}


def test_hot_pairs_are_left_out_only_where_others_tie():
    """Of two linked short sets, the first shares at least (n - 1) // 2 of its pairs, whatever is missing."""
    rng = random.Random(12)
    for _ in range(20_000):
        n = rng.randint(7, 60)
        gone = rng.randint(0, n // 4)
        more = rng.randint(0, (n - gone) // 3 - gone) if (n - gone) // 3 >= gone else 0
        if 4 * (n - gone) < 3 * (n + more):
            continue
        x = sorted(rng.sample(range(1, 10_000), n))
        y = sorted(set(x) - set(rng.sample(x, gone)) | set(rng.sample(range(10_001, 20_000), more)) if rng.random() < 0.5 else
                   set(x) - set(x[1:2 * gone:2]) | {v + 0.5 for v in rng.sample(x, more)})
        if 4 * len(set(x) & set(y)) < 3 * len(set(x) | set(y)):
            continue
        assert len(set(zip(x, x[1:])) & set(zip(y, y[1:]))) >= (n - 1) // 2


def test_signature_tree_finds_all_links():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 12))):
            sets.append(np.unique(np.concatenate((base[rng.random(len(base)) > 0.08], rng.integers(0, 1 << 63, 1 + len(base) // 20, dtype=np.uint64)))))
    union, want = brute.Union(), brute.Union()
    for i, j in jaccard.join_sets(sets):
        union.join(i, j)
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(a, sets[j]))
            if 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                want.join(j, i)
    assert [union.find(i) for i in range(len(sets))] == [want.find(i) for i in range(len(sets))]


def test_first_of_each_group_stays(spark, corpus):
    rows = [(88 if d == 8 and t != corpus[8][1] else d, t) for d, t in corpus]
    docs, plain = frame(spark, rows), brute.jaccard(rows)
    kept = jaccard.first_of_each(docs)
    want = [d for d, n, c in plain if n == 0] + sorted({c for _, n, c in plain if n and c is not None}) + [None]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(want) and kept.columns == docs.columns


def test_repeats_are_removed(spark, corpus):
    got = repeats.remove(frame(spark, corpus)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.repeats(corpus)))
    assert sum(r.n_removed for r in got) > 10_000


def test_frequent_sections_are_counted(spark, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 2)
    got = repeats.remove(frame(spark, corpus)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.repeats(corpus)))


def test_repeats_keep_other_columns(spark, corpus):
    docs = frame(spark, corpus)
    got = repeats.remove(docs, own=True)
    assert got.columns == docs.columns and got.where("text IS NULL").count() == 1 and got.where("size <> 'x'").count() == 0
    left = {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.where("text IS NOT NULL").collect()}
    whole = {(r.doc_id, r.kept_sha256) for r in repeats.remove(docs).where("n_removed = 0 AND doc_id <> 150").collect()}
    assert whole <= left


def test_suffix_array_and_statistics():
    rng = random.Random(9)
    for _ in range(20):
        raw = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 300)))
        order = repeats.suffix_array(np.frombuffer(raw, np.uint8).astype(np.int64))
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    pieces = [bytes(rng.choice(b"abc") for _ in range(900)) for _ in range(4)]
    pieces += [pieces[0][100:700], pieces[1][:450] + pieces[2][300:], b"", b"a" * 900]
    count = Counter(p[k : k + 400] for p in pieces for k in range(len(p) - 399))
    for p, starts in zip(pieces, repeats.repeated_starts(pieces)):
        assert starts.tolist() == [k for k in range(len(p) - 399) if count[p[k : k + 400]] > 1]


def test_anchors_of_very_long_texts(monkeypatch):
    rng = random.Random(4)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(9000))
    want = repeats.anchors([text])
    monkeypatch.setattr(repeats, "PLACE", 11)
    got = repeats.anchors([text])
    windows = lambda found: {p: int(k) for _, keys, lo, hi in found for k, a, b in zip(keys, lo, hi) for p in range(a, b + 1)}
    assert len(windows(want)) == len(windows(got)) == len(text) - 399


def test_packing(spark, corpus):
    sizes = packing.Sizes((16, 64, 256))
    rows = corpus + [(400 + i, "same text again") for i in range(30)] + [(400, "same text again")] * 5
    got = packing.pack(frame(spark, rows), sizes, pieces_per_group=50).collect()
    words = Counter()
    for d, t in rows:
        n = len(brute.WORD.findall(t or ""))
        for k in range(max(1, -(-n // 256))):
            words[(d, k, k * 256 if n else 0, min(256, n - k * 256))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == words
    bins = defaultdict(list)
    for r in got:
        if r.length:
            bins[r.sequence].append(r)
    for rs in bins.values():
        rs.sort(key=lambda r: r.position)
        assert [r.position for r in rs] == list(range(len(rs))) and len({r.capacity for r in rs}) == 1
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))]
        assert rs[0].capacity == min(c for c in sizes.lengths if c >= sum(r.length for r in rs))
    again = packing.pack(frame(spark, rows).repartition(3), sizes, pieces_per_group=50).collect()
    assert Counter(again) == Counter(got)


def test_best_fit_by_hand():
    bins, capacity = packing.pack_lengths([5, 3, 3, 2, 9], packing.Sizes((4, 10), 1, 0))
    assert capacity == [10, 10, 4] and bins == [1, 1, 2, 1, 0]


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    rng = random.Random(8)
    rows = [(1, prose(rng, 200) + "\nReleased under the MIT License.\n" + prose(rng, 30)), (2, "LICENSED UNDER the apache license, version 2.0!"),
            (3, mit.replace("any person", "every person")), (4, prose(rng, 500)), (5, None), (6, "Released under the MIT"), (None, "Licensed under CC BY-NC 4.0."),
            (7, "\n".join([prose(rng, 40), "Licensed under CC BY-NC 4.0."] * 3)), (8, mit[: len(mit) // 2])]
    got = licenses.scan(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.license) for r in got) == Counter(
        [(1, "MIT"), (2, "Apache-2.0"), (3, "MIT"), (None, "CC-BY-NC-4.0"), *[(7, "CC-BY-NC-4.0")] * 3]
    )
    assert {r.matched for r in got if r.doc_id in (1, 7)} == {"Released under the MIT License", "Licensed under CC BY-NC 4.0"}
    for r in got:
        text = dict(rows)[r.doc_id]
        assert text.encode()[r.start_byte : r.end_byte].decode() == r.matched and 100 * r.n_found >= 75 * r.n_shingles


def test_licenses_are_told_apart(spark):
    gnu = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    notices = {
        "GPL-3.0": gnu.format("program", ":", "", ",", "3"), "GPL-2.0": gnu.format("program", ";", "", ";", "2"),
        "AGPL-3.0": gnu.format("program", ":", "Affero ", ",", "3"), "LGPL-3.0": gnu.format("library", ":", "Lesser ", ",", "3"),
        "LGPL-2.1": gnu.format("library", ";", "Lesser ", ";", "2.1"), "": gnu.format("program", ";", "", ";", "1"),
    }
    full = dict(licenses._full_texts())
    rows = list(enumerate([*notices.values(), *full.values()]))
    rows += [(100, (notices["GPL-2.0"] + " ") * 3), (101, notices["GPL-3.0"] + "\n" + notices["AGPL-3.0"])]
    rows += [(102, full["BSD-2-Clause"] * 2), (103, "Apache: " + full["Apache-2.0"].replace("Derivative Works", "Other Works") + full["MIT"])]
    got = defaultdict(list)
    for r in licenses.scan(frame(spark, rows)).collect():
        got[r.doc_id].append(r)
    ids = lambda d: {r.license for r in got[d]}
    assert [ids(i) for i in range(6)] == [{n} if n else set() for n in notices]
    for i, name in enumerate(full, 6):
        assert any(r.license == name and 100 * (r.end_byte - r.start_byte) > 75 * len(full[name].encode()) for r in got[i]), name
    longest = lambda d: max(Counter((r.license, r.notice) for r in got[d]).values())
    assert longest(100) == 3 and ids(100) == {"GPL-2.0"} and ids(101) == {"GPL-3.0", "AGPL-3.0"}
    assert ids(102) == {"BSD-2-Clause"} and longest(102) == 2 and ids(103) == {"Apache-2.0", "MIT"}


def test_shingle_sets_tell_words_apart():
    texts = ["a b c d e f", "A B  C\td e\nf", "a b", "a b c d e f a b c d e f", "", "ab c d e f"]
    sets = shingles.sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(brute.shingles(t)) for t in texts]
    assert sets[0].tolist() == sets[1].tolist() and not np.intersect1d(sets[0], sets[5]).size


def test_bpe_round_trip(spark, corpus, tmp_path, monkeypatch):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = str(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rows = corpus + [(500, "don't  stop\n\n 12345 ÄÖ 日本語 🙂🙂 <|endoftext|> \u0000x"), (501, "y" * 3000)]
    got = bpe.tokenize(frame(spark, rows), path, tokenizers.PATTERN, ids=True).collect()
    want = Counter()
    for d, t in rows:
        ids = plain.encode_ordinary(t or "")
        want[(d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in got) == want
    codec = bpe.Codec(bpe.read_ranks(path))
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    for text in ("one two three four five six seven eight nine ten eleven twelve", "one thirteen fourteen two fifteen"):
        pieces = text.split(" ")
        codec.prepare(pieces)
        assert codec.decode(codec.encode(pieces)) == [p.encode() for p in pieces]


def test_bpe_of_long_words(spark):
    import public_tokenizers as tokenizers
    import tiktoken

    path = str(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ranks = bpe.read_ranks(path)
    plain = tiktoken.Encoding("plain", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    random = np.random.default_rng(7)
    letters = lambda n, of: "".join(random.choice(list(of), n))
    rows = [
        letters(10_000, "abcdefghijklmnopqrstuvwxyz"), letters(20_000, "ACGT"), "a" * 5_000, "ab" * 3_000, "-" * 3_001, "=" * 257, " " * 4_000,
        letters(3_000, "的一是不了在人有我他这中大来上"), letters(8_000, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        letters(5_000, "etaoin"), letters(257, "the"), letters(2_000, "สวัสดีครับ"), "the" * 400, letters(9_000, "01"),
    ]
    got = bpe.tokenize(frame(spark, list(enumerate(rows))), path, tokenizers.PATTERN, ids=True).collect()
    assert all(r.ids == plain.encode_ordinary(rows[r.doc_id]) for r in got) and len(got) == len(rows)
    # Every way of merging gives the same: the query, steps of one rank, and pieces between cuts.
    codec = bpe.Codec(ranks)
    for n in (2, 5, 60, 200):
        for of in ("ab", "etaoin s", "的一是", "ACGT", "ing the"):
            word = letters(n, of).encode()
            want = codec.merged([word])[word]
            assert codec.merged_long(word).tolist() == want
            assert [i for p in codec.cuts(word) for i in codec.merged_long(p).tolist()] == want


def test_bpe_of_a_run_of_a_megabyte():
    import public_tokenizers as tokenizers

    codec = bpe.Codec(bpe.read_ranks(str(tokenizers.path("byte_bpe_multi_50k.tiktoken"))))
    random = np.random.default_rng(8)
    for of in ("abcdefghijklmnopqrstuvwxyz", "a", "的一是不了在人有我他"):
        word = "".join(random.choice(list(of), (1 << 20) // len(of[0].encode())))
        codec.prepare([word])
        assert codec.decode(codec.encode([word])) == [word.encode()]
        codec.prepare(["a"])
        assert word not in codec.ids


def test_only_tied_suffixes_are_sorted_again(monkeypatch):
    rng = np.random.default_rng(5)
    part = rng.integers(0, 256, 3000)
    for symbols in (np.concatenate((rng.integers(0, 256, 20_000), part, [256], part, [256])), np.zeros(300), np.tile([1, 2, 3], 200), np.array([256])):
        symbols = np.append(symbols, 256).astype(np.int16)
        text = symbols.astype(">i2").tobytes()
        sorted_, argsort = [], np.argsort
        with monkeypatch.context() as m:
            m.setattr(np, "argsort", lambda x, *a: sorted_.append(len(x)) or argsort(x, *a))
            got = repeats.suffix_array(symbols)
        assert got.tolist() == sorted(range(len(symbols)), key=lambda i: text[2 * i :])
        if len(symbols) > 20_000:
            assert sorted_[0] == len(symbols) and max(sorted_[1:]) <= 2 * len(part) + 4

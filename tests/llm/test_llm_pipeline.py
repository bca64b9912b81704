"""The pipeline's stages and rows, and the registered queries over whole tables."""

import hashlib
from collections import Counter

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return entry.queries()[name](spark, SF_DIR).collect()


def test_all_operators_are_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in entry.queries()


def test_queries_on_documents(spark):
    docs = texts(spark)
    got = {r.doc_id: r for r in rows(spark, "op2_quality_rules")}
    for d, t in docs:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.metrics(t)
    shorter = {d: (n, k) for d, _, n, k, _ in brute.repeats(docs, 250)}
    want = sorted((*r, *shorter[r[0]]) for r in brute.repeats(docs))
    assert sorted(map(tuple, rows(spark, "op5_suffix_array_dedup"))) == want
    assert sum(r[2] != r[5] for r in want) > 3
    assert sorted(map(tuple, rows(spark, "op7_ngram_jaccard_join"))) == sorted(brute.jaccard(docs))
    assert {r.decoded_sha256 for r in rows(spark, "op8_byte_bpe")} == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in docs}
    assert Counter(r.doc_id for r in rows(spark, "op1_sharding")) == Counter(d for d, _ in docs)


def test_query_on_embeddings(spark):
    plain = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, rows(spark, "op9_embedding_near_dedup"))) == sorted(brute.near(plain, 0.98))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "best_fit_packing"]
    kept = stages["quality_rules"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows(spark, "op2_quality_rules") if r.kept}
    single = stages["ngram_jaccard_join"](spark, kept, SF_DIR).cache()
    plain = [(r.doc_id, r.text) for r in kept.collect()]
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute.jaccard(plain)}
    left = stages["suffix_array_dedup"](spark, single, SF_DIR).cache()
    want = {d: s for d, _, n, _, s in brute.repeats([(r.doc_id, r.text) for r in single.collect()], 250) if not n}
    got = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in left.collect()}
    assert left.columns == docs.columns and all(got[d] == s for d, s in want.items()) and len(got) == single.count()
    packed = stages["best_fit_packing"](spark, left, SF_DIR).collect()
    words = {r.doc_id: len(brute.WORD.findall(r.text)) for r in left.collect()}
    total = Counter()
    for r in packed:
        total[r.doc_id] += r.length
    assert total == Counter(words)
    run = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(map(tuple, run)) == Counter(map(tuple, packed))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_empty_tables(spark, name):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, SF_DIR).count() == 0

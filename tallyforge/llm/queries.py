"""Registered queries of the operators, with their SQL statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import (
    bpe, embeddings, html, jaccard, licenses, packing, phrases, private, quality, repeats, sharding, variants, warc,
)
from tallyforge.llm.common import table
from tallyforge.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"), 8)


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and verdict of every document."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.METRICS, "base_failed", "kept", "posterior")


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op5_suffix_array_dedup")
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated 400-byte strings leave of every document, and what shorter passages would take."""
    return repeats.remove(table(spark, sf_dir, "documents"), passage=repeats.PASSAGE)


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op7_ngram_jaccard_join")
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-equal documents."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, and what they decode to."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.tokenize(table(spark, sf_dir, "documents"), str(vocabulary), public_tokenizers.PATTERN)


_NEAR = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), fine AS (
    SELECT * FROM v
    WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, CAST((SELECT count(*) FROM links l WHERE l.a = c.vec_id) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM component c
"""


@query("op9_embedding_near_dedup", _NEAR)
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal labels."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


_WARC = """
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
    CASE WHEN strlen(h) >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN strlen(h) >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages) p
"""


@query("op10_warc", _WARC)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    found = warc.archive(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _grams(sizes) -> str:
    """Phrases of the words w1 to w5 of every place, of all sizes."""
    words = lambda n: " || ' ' || ".join(f"w{i}" for i in range(1, n + 1))
    return " UNION ALL ".join(
        f"SELECT lang, {n} AS size, {words(n)} AS phrase, count(*) AS f FROM runs WHERE w{n} IS NOT NULL GROUP BY lang, {words(n)}"
        + " HAVING count(*) >= 100" * (n > 1)
        for n in sizes
    )


_PHRASES = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, id, unnest(w) AS word, generate_subscripts(w, 1) AS i
    FROM (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces) x
), runs AS MATERIALIZED (
    SELECT lang, word AS w1, lead(word, 1) OVER piece AS w2, lead(word, 2) OVER piece AS w3, lead(word, 3) OVER piece AS w4,
        lead(word, 4) OVER piece AS w5
    FROM worded WINDOW piece AS (PARTITION BY id ORDER BY i)
), counts AS MATERIALIZED (
    {_grams(range(1, 6))}
), totals AS (
    SELECT lang, CAST(sum(f) AS HUGEINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), several AS MATERIALIZED (
    SELECT * FROM counts WHERE size > 1
), kept AS MATERIALIZED (
    SELECT * FROM several c WHERE NOT EXISTS (
        SELECT 1 FROM several d WHERE d.lang = c.lang AND d.size > c.size AND 100 * d.f >= 100 * c.f
            AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')
    )
), cuts AS (
    SELECT lang, phrase, f AS a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM kept) x
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, r.f AS r, t.n,
        CAST((1000::HUGEINT * c.a * t.n) // (CAST(h.f AS HUGEINT) * r.f) AS BIGINT) AS score
    FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest
    JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS turn FROM scored
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE turn = 1
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    CAST(n AS BIGINT) AS n, score
FROM ranked WHERE rank <= 2000
"""


@query("op11_phrase_collocations", _PHRASES)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language over all documents."""
    return phrases.mine(table(spark, sf_dir, "documents"))


@query("op12_pii_bootstrap")
def op12_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: fixed shapes, and what stands where they usually stand."""
    return private.find(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent words they are misspellings of."""
    return variants.group(table(spark, sf_dir, "documents"))

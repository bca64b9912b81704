"""From raw documents to packed training sequences: four stages, each one operator of tallyforge.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read
back as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import jaccard, packing, quality, repeats
from tallyforge.llm.common import settle, table
from tallyforge.session import tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that weak supervision rejects go."""
    return quality.good_documents(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.first_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of about 50 words or more that occur more than once are cut out; the character count follows."""
    left = repeats.remove(docs, own=True, length=repeats.PASSAGE)
    return left.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in left.columns else left


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Best-fit packing and suffix arrays are not SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

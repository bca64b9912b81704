"""Helpers the operators share: scratch tables, row selection and component labels."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import shared_dir

# The white space that separates words. Everything else belongs to a word.
BLANKS = r"[\x20\x09-\x0D]+"


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: lineage ends there, so a lost executor
    costs a re-read."""
    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def left_out(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    """``docs`` without columns whose names an operator needs for itself."""
    return docs.drop(*[c for c in docs.columns if c in names])


def slices(rows: int, per_slice: int) -> int:
    """How many parts of about ``per_slice`` rows."""
    return max(1, math.ceil(rows / per_slice))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Links that one task joins up at a time.
PART = 200_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one part as stars: every node with the smallest one it reaches there."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while up[root] != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            up.setdefault(a, a), up.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                up[max(x, y)] = min(x, y)
    rows = [(x, find(x)) for x in up]
    rows = [r for r in rows if r[0] != r[1]]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["a", "b"])


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``, longs): rows (``node``, ``root``) with the smallest
    node that each can reach. Nodes without a link to another do not appear.

    A round joins up parts of at most PART links, each in one task, and then the parts with each other by
    a large-star and a small-star step: every node's links become links to its smallest neighbour. The
    work of a round is linear in the links, no node's links are gathered (minima are partially aggregated
    and joined back), and every round is written to the shared folder.
    """
    links = settle(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b"), f"{name}-links")
    for _ in range(max_rounds):
        parts = slices(links.count(), PART)
        stars = links.coalesce(parts).mapInArrow(_contract, "a long, b long")
        if parts == 1:
            links = settle(stars, f"{name}-links")
            break
        links = settle(stars.distinct(), f"{name}-links")
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), f"{name}-links")
        # Done when the links are stars: no node has two parents and no parent has a parent.
        state = links.agg(F.count("*").alias("n"), F.countDistinct("a").alias("d")).first()
        nested = links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        if state["n"] == state["d"] and not nested:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

"""Group statistics, ranks and sequences over hot keys; parent joins are split at run time."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.ranking import global_dense_rank, sequence_in_group, top_per_group, top_values
from tallyforge.operators.skew import with_group_stats


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(5)
    data = [(i, "hot" if i % 3 == 0 else f"k{pick.randrange(40)}", pick.randrange(1, 60)) for i in range(3000)]
    return data, spark.createDataFrame(data, "id BIGINT, k STRING, v BIGINT")


def test_group_stats_equal_brute_force(rows):
    data, frame = rows
    sums, counts = Counter(), Counter()
    for _, k, v in data:
        sums[k] += v
        counts[k] += 1
    got = with_group_stats(frame, ["k"], {"total": F.sum("v"), "n": F.count(F.lit(1))})
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, k, v, sums[k], counts[k]) for i, k, v in data)


def test_group_stats_of_missing_keys(spark):
    frame = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id BIGINT, k STRING")
    got = with_group_stats(frame, ["k"], {"n": F.count(F.lit(1))})
    assert sorted((r["id"], r["n"]) for r in got.collect()) == [(1, 2), (2, 2), (3, 1)]


def test_global_dense_rank(rows):
    data, frame = rows
    order = {v: n for n, v in enumerate(sorted({v for *_, v in data}, reverse=True), 1)}
    got = global_dense_rank(frame, "v", "rank", slices=7)
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, k, v, order[v]) for i, k, v in data)


def test_sequence_and_tops(spark, rows):
    data, frame = rows
    staged = frame.withColumn("period", (F.col("v") / 10).cast("int"))
    got = {r["id"]: r["n"] for r in sequence_in_group(staged, "k", "period", ["v", "id"], "n").collect()}
    seen = Counter()
    for i, k, v in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        seen[k] += 1
        assert got[i] == seen[k]
    best = sorted({v for *_, v in data}, reverse=True)[:3]
    assert sorted(r["id"] for r in top_values(frame, "v", 3, "r").collect()) == sorted(i for i, _, v in data if v in best)
    limits = {k: sorted({v for _, q, v in data if q == k}, reverse=True)[:2] for _, k, _ in data}
    expected = sorted((i, limits[k].index(v) + 1) for i, k, v in data if v in limits[k])
    assert sorted((r["id"], r["r"]) for r in top_per_group(frame, "k", "v", 2, "r").collect()) == expected


def test_parent_join_is_split_at_run_time(spark, rows):
    """A child table with one hot parent: the shuffled join reports skew handling in its final plan."""
    child = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("parent_id"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )
    parent = spark.range(200_000).select(F.col("id").alias("parent_id"), (F.col("id") * 2).alias("y"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        joined = child.join(parent, "parent_id", "left").agg(F.sum("y"), F.count("pad"))
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan

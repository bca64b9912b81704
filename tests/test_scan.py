"""Prefix scans: numbers equal a plain count, hot groups are spread."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import scan
from tallyforge.operators.scan import number_in_groups, number_values
from tallyforge.session import settler as session_settler


def plain(rows):
    seen, out = Counter(), {}
    for i, k, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2], r[0])):
        seen[k] += 1
        out[i] = seen[k]
    return out


@pytest.mark.parametrize("parts", ["1", "7", "40"])
@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_numbers_in_groups(spark, parts, coalesce):
    draw = random.Random(5)
    # One key holds most rows, some keys one row, and some have no key.
    rows = [(i, draw.choice(["hot"] * 6 + ["a", "b", None, f"k{i}"]), draw.randrange(9)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id BIGINT, k STRING, v INT").withColumn("_at", F.lit("x"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        got = number_in_groups(frame.drop("_at"), ["k"], ["v", "id"], "n")
        assert got.columns == ["id", "k", "v", "n"]
        assert {r["id"]: r["n"] for r in got.collect()} == plain(rows)
        one = number_in_groups(frame.select("id", F.lit("all").alias("k"), "v"), ["k"], ["v", "id"], "n").collect()
        assert {r["id"]: r["n"] for r in one} == plain([(i, "all", v) for i, _, v in rows])
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_numbers_of_several_keys_types_and_of_nothing(spark):
    frame = spark.sql("SELECT id, CAST(id % 3 AS DECIMAL(5,2)) AS d, DATE'2020-01-01' + INT(id % 2) AS t FROM range(60)")
    got = number_in_groups(frame, ["d", "t"], ["id"], "n").collect()
    seen = Counter()
    for r in sorted(got, key=lambda r: r["id"]):
        seen[r["d"], r["t"]] += 1
        assert r["n"] == seen[r["d"], r["t"]]
    assert number_in_groups(frame.filter("id < 0"), ["d"], ["id"], "n").collect() == []
    assert number_values(frame.filter("id < 0").select("id"), [F.asc("id")], "n").collect() == []


def test_a_hot_group_leaves_no_large_part(spark, monkeypatch):
    written = []
    monkeypatch.setattr(scan, "settler", lambda session: lambda name, f: written.append(session_settler(session)(name, f)) or written[-1])
    # A third of all rows is one customer on one day.
    frame = spark.sql("SELECT id, IF(id % 3 = 0, -1, id) AS k, IF(id % 3 = 0, 0, id % 11) AS day FROM range(0, 60000, 1, 8)")
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = number_in_groups(frame, ["k"], ["day", "id"], "n")
        parts = sorted(r["count"] for r in written[0].groupBy("_part").count().collect())
        assert len(parts) == 12 and parts[-1] <= 2 * parts[len(parts) // 2]
        assert got.filter("k = -1").agg(F.max("n"), F.count_distinct("n")).first()[:] == (20000, 20000)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_numbers_of_values(spark):
    values = [v * 7 % 1009 for v in range(1009)] + [None]
    frame = spark.createDataFrame([(v,) for v in values], "v BIGINT")
    got = {r["v"]: r["n"] for r in number_values(frame, [F.desc("v")], "n", 6).collect()}
    assert got == {**{v: 1009 - v for v in range(1009)}, None: 1010}

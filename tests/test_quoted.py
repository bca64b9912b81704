"""Files with quoted line breaks, cut anywhere, read as whole files are read."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge.sources import csv, quoted

COLUMNS = ["a", "b"]


def read(frame):
    return [tuple(r) for r in frame.drop("record").orderBy("source_row").collect()]


def both(spark, path, cut):
    whole = read(csv.scan(spark, path, COLUMNS, whole_files=True))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(cut))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        split = csv.scan(spark, path, COLUMNS)
        tasks = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
        return whole, read(split), tasks
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


@pytest.mark.parametrize("line,inside,after", [
    ("a,b", False, False), ("a,b", True, True), ('a,"b', False, True), ('b"', True, False), ('b",c', True, False), ('""', False, False),
    ('""', True, True), ('"""', False, True), ('"""', True, False), ('a"b,c', False, False), ('"a""', False, True), ('x","', True, True),
    ("", False, False), ("", True, True), ('"a" x,"b', False, True), (' "a', False, False), ('"a,b"', False, False), ('"a,b', False, True),
])
def test_states_of_lines(line, inside, after):
    assert quoted.state_after(line, inside) is after


def test_states_of_a_long_line():
    assert quoted.state_after('"' + '""' * 10**6, False) is True
    assert quoted.state_after("x," * 10**6 + '"', False) is True


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("cut", [29, 333, 100_000])
def test_split_files_read_like_whole_ones(spark, tmp_path, end, cut):
    draw = random.Random(cut)
    cells = ["", "x", "007", "two words", "q\"q", "c,c", "l\nl", "\n\n", "\"", "l\n\"q\",\nz", "y" * 30, "é\nß"]
    quote = lambda c: '"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') or draw.random() < 0.2 else c
    folder = tmp_path / "t.csv"
    folder.mkdir()
    total = 0
    for part in range(3):
        rows = [[draw.choice(cells), f"{part}-{i}"] for i in range(25 if cut < 100 else 300)]
        total += len(rows)
        text = "a,b\n" + "".join(",".join(map(quote, r)) + "\n" + "\n" * (draw.random() < 0.1) for r in rows)
        (folder / f"part-{part}.csv").write_bytes(text.replace("\n", end).encode())
    whole, split, tasks = both(spark, str(folder), cut)
    assert split == whole and [r[2] for r in split] == list(range(2, total + 2))
    assert cut > 1000 or tasks > 10


def test_one_record_over_many_blocks_and_ragged_ones(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(('﻿a,b\n1,"' + "line, \"\"x\"\"\n" * 200 + '"\n2\n3,"4\n5",6\n   \n7,8').encode())
    whole, split, tasks = both(spark, str(path), 100)
    assert split == whole and tasks > 20
    assert [(n, bad) for *_, n, bad in split] == [(2, False), (3, True), (4, True), (5, True), (6, False)]
    assert split[0][1].count("\n") == 200


def test_lines_of_plain_records_are_not_shuffled(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "".join(f"{i},x\n" for i in range(500)))
    plan = quoted.records(spark, str(path))._jdf.queryExecution().optimizedPlan().toString()
    kept = [line for line in plan.splitlines() if "Aggregate" in line]
    assert len(kept) <= 3 and csv.scan(spark, str(path), COLUMNS).agg(F.count_distinct("source_row")).first()[0] == 500


def test_headers_of_all_files_are_checked(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text('"b",a\n3,4\n')
    with pytest.raises(Exception, match="header"):
        csv.scan(spark, str(folder), COLUMNS).collect()


def test_lines_meet_their_blocks_without_a_shuffle(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "".join(f'{i},"x\ny"\n' for i in range(50)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quoted.records(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_states_of_lines_that_follow_each_other():
    draw = random.Random(7)
    for _ in range(100):
        lines = ["".join(draw.choice('",ab') for _ in range(draw.randint(0, 7))) for _ in range(draw.randint(1, 20))]
        got = quoted._states(pa.array(lines), np.array(['"' in x for x in lines]), [0, 1])
        for s in (0, 1):
            now = bool(s)
            for i, line in enumerate(lines):
                now = quoted.state_after(line, now)
                assert bool(got[s][i]) is now

"""Versioned reloads and counting writes."""

import json

import pytest
from pyspark.sql import functions as F

from tables import CONFIG
from test_run import EXPECTED, FILES, content, delivery  # noqa: F401
from tallyforge.plans import run as runs
from tallyforge.plans.checks import ValidationError
from tallyforge.sources import versions
from tallyforge.sources.observed import write_counted


def test_write_counts_what_it_writes(spark, tmp_path):
    frame = spark.range(1000).withColumn("kind", F.when(F.col("id") % 10 == 0, "a").otherwise("b"))
    tallies = {"a_rows": F.count_if(F.col("kind") == "a")}
    path = str(tmp_path / "counted")
    for partition_by in ([], ["kind"]):
        assert write_counted(frame.repartition(7), path, tallies, partition_by=partition_by) == {"rows": 1000, "a_rows": 100}
        assert spark.read.parquet(path).count() == 1000
    assert write_counted(frame.where("kind = 'c'"), path, tallies) == {"rows": 0, "a_rows": 0}
    assert write_counted(spark.createDataFrame([], frame.schema), path, tallies) == {"rows": 0, "a_rows": 0}


def test_a_load_that_dies_leaves_the_version_before(spark, delivery, tmp_path, monkeypatch):  # noqa: F811
    raw, root = str(delivery / "raw"), str(tmp_path / "out")
    with pytest.raises(versions.NoVersionError):
        versions.read(spark, root, "analysis/order_summary")
    first = runs.reload(spark, raw, root, CONFIG, csv_outputs=False)
    assert first.number == 1 and first.rows == {"customers": 3, "products": 2, "orders": 4, "order_lines": 4, "returns": 3}
    names = [("parquet", f"{first.folder}/{n}") for n in ("labelled/returns", "analysis/product_summary", "facts/sales_lines")
             if (tmp_path / "out" / first.folder / n).exists()]
    before = {n: content(spark, root, k, n) for k, n in names}
    shown = sorted(map(str, versions.read(spark, root, "analysis/order_summary").collect()))

    # Equal input and settings: nothing is loaded again.
    assert runs.reload(spark, raw, root, CONFIG, csv_outputs=False) == first
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 1

    # Dies while staging is checked.
    stored = runs._stored

    def dies(session, frame, path):
        if path.endswith("checks/staging"):
            raise RuntimeError("lost")
        return stored(session, frame, path)

    monkeypatch.setattr(runs, "_stored", dies)
    with pytest.raises(RuntimeError, match="lost"):
        runs.reload(spark, raw, root, CONFIG, csv_outputs=False, force=True)
    monkeypatch.setattr(runs, "_stored", stored)
    assert versions.current(spark, root) == first

    # A run whose checks fail has written all its outputs and is not committed.
    wrong = tmp_path / "wrong.json"
    wrong.write_text(json.dumps({**EXPECTED, "net_sales": "1.00"}))
    with pytest.raises(ValidationError):
        runs.reload(spark, raw, root, CONFIG, csv_outputs=False, expectations=str(wrong))
    assert versions.current(spark, root) == first
    assert before == {n: content(spark, root, k, n) for k, n in names}

    second = runs.reload(spark, raw, root, CONFIG, csv_outputs=False, force=True)
    assert second.number == 2 and second.folder != first.folder and second.fingerprint == first.fingerprint
    assert shown == sorted(map(str, versions.read(spark, root, "analysis/order_summary").collect()))
    gone = versions.prune(spark, root, keep=2)
    assert len(gone) == 2 and first.folder not in gone
    assert versions.prune(spark, root, keep=1) == [first.folder] and versions.current(spark, root) == second
    assert shown == sorted(map(str, versions.read(spark, root, "analysis/order_summary").collect()))
    with pytest.raises(ValueError):
        versions.prune(spark, root, keep=0)


def test_changed_input_is_loaded_again(spark, delivery):  # noqa: F811
    raw = str(delivery / "raw")
    same = [runs._fingerprint(spark, raw, CONFIG, {"csv_outputs": False}) for _ in range(2)]
    assert same[0] == same[1] != runs._fingerprint(spark, raw, CONFIG, {"csv_outputs": True})
    path = delivery / "raw" / "returns.csv"
    path.write_text(FILES["returns"] + "R00009,L000002,2025-03-01,1,damaged\n")
    assert runs._fingerprint(spark, raw, CONFIG, {"csv_outputs": False}) != same[0]
    path.write_text(FILES["returns"])
    assert runs._fingerprint(spark, raw, CONFIG, {"csv_outputs": False}) == same[0]


def test_commits_at_once_read_alike(spark, tmp_path):
    root = str(tmp_path)
    versions.commit(spark, root, "versions/a")
    # Two loads that both saw version 1.
    for folder in ("versions/c", "versions/b"):
        spark.createDataFrame([(2, folder, "", None, {})], versions._COMMIT).coalesce(1).write.json(f"{root}/commits/{folder[-1]}")
    assert versions.current(spark, root).folder == "versions/c"
    # A commit that died has a folder without a row.
    (tmp_path / "commits" / "0000000003-x").mkdir()
    assert versions.commit(spark, root, "versions/d").number == 3

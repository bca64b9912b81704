"""What crosses shuffles and what stays on disk while tables are cleaned and facts are stored."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tables import CONFIG, CUSTOMER, LINE, ORDER, PRODUCT, event, outcome, parents, raw
from tallyforge.operators.clean import Cleaning, clean_table, with_parent_flags
from tallyforge.operators.identity import hot_keys, with_identity
from tallyforge.operators.normalize import field_value, read_fields
from tallyforge.session import settler


@pytest.fixture
def unbroadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString().splitlines()


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_stored_frames_leave_no_shuffle_files(spark):
    frame = spark.range(50_000).groupBy((F.col("id") % 999).alias("k")).count()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(setting)
    stored = settler(spark)("grouped", frame)
    assert _shuffle_files(spark) <= before and spark.conf.get(setting) == was
    assert stored.count() == frame.count() == 999


def test_tables_are_cleaned_when_they_are_read(spark):
    names = []
    tables = {t.name: raw(spark, t.name, row) for t, row in zip(CONFIG.tables, (CUSTOMER, PRODUCT, ORDER, LINE, event(1, 2)))}
    cleaning = Cleaning(tables, CONFIG, lambda name, frame: names.append(name) or frame)
    assert cleaning["customers"].count() == 1 and names == ["customers"]
    assert cleaning["orders"].count() == 1 and names == ["customers", "orphans_customers", "orders"]
    assert [frame.count() for frame in cleaning.values()] == [1] * 5 and list(cleaning) == [t.name for t in CONFIG.tables]
    assert len(names) == len(set(names)) == 10


def test_lines_are_shuffled_unparsed(spark, unbroadcast):
    lines = plan(clean_table(raw(spark, "order_lines", LINE), CONFIG.table("order_lines"), parents(spark), CONFIG))
    # Two for each parent and one by key, below which nothing is parsed but keys.
    assert sum("Exchange hashpartitioning" in line for line in lines) == 5
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(_key#" in line)
    assert not any("rlike" in line.lower() or "_t_quantity" in line for line in lines[at:])


def _rows(spark):
    draw = random.Random(7)
    rows = [(draw.choice(["", " ", "C7301", "c7301 ", "C7302", f"C8{i % 40:03}"]), draw.choice("AB"), "East", "Consumer", "") for i in range(300)]
    ragged = [draw.random() < 0.1 for _ in rows]
    frame = raw(spark, "customers", *rows)
    marks = spark.createDataFrame([(n, r) for n, r in enumerate(ragged, 2)], "n BIGINT, ragged BOOLEAN")
    return rows, ragged, frame.join(marks, F.col("source_row") == F.col("n")).drop("n")


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_records_and_conflicts_equal_brute_force(spark, hot_rows):
    rows, ragged, frame = _rows(spark)
    spec = CONFIG.table("customers")
    assert bool(hot_keys(frame, spec, CONFIG, hot_rows)) == (hot_rows == 10)
    first, records = {}, defaultdict(set)
    for n, (row, bad) in enumerate(zip(rows, ragged), 2):
        record = (row[0].strip().upper(), row[1], bad)
        first.setdefault(record, n)
        if not bad:
            records[record[0]].add(record)
    want = {}
    for n, (row, bad) in enumerate(zip(rows, ragged), 2):
        record = (row[0].strip().upper(), row[1], bad)
        want[n] = (record[0] or None, first[record], first[record] != n, len(records[record[0]]) > 1 and not bad)
    got = with_identity(read_fields(frame, spec, CONFIG), spec, CONFIG, hot_rows)
    fields = ("business_key", "retained_source_row", "_copy", "_key_conflict")
    assert {r["source_row"]: tuple(r[c] for c in fields) for r in got.collect()} == want


def test_hot_keys_get_the_same_labels(spark, monkeypatch):
    _, _, frame = _rows(spark)
    want = outcome(clean_table(frame, CONFIG.table("customers"), {}, CONFIG))
    monkeypatch.setattr("tallyforge.operators.clean.hot_keys", lambda raw, spec, config: hot_keys(raw, spec, config, 10))
    assert outcome(clean_table(frame, CONFIG.table("customers"), {}, CONFIG)) == want and len(want) == 300


def test_orphans_are_the_rows_without_a_parent(spark):
    spec = CONFIG.table("order_lines")
    cells = [("L1", "o58213 ", "P417"), ("L2", "O1", "p417"), ("L3", None, "P9"), ("L4", "", None)]
    frame = raw(spark, "order_lines", *[(*c, "1", "1", "0") for c in cells])
    flags = lambda rows: {r["source_row"]: (r["_has_orders"], r["_has_products"]) for r in rows.collect()}
    want = {2: (True, True), 3: (False, True), 4: (False, False), 5: (False, False)}
    value = lambda name: field_value(spec, name, CONFIG)
    assert flags(with_parent_flags(frame, spec, parents(spark), value, settler(spark))) == want
    assert flags(with_parent_flags(frame, spec, parents(spark), value)) == want
    twice = {n: p.unionByName(p) if n == "orders" else p for n, p in parents(spark).items()}
    for settle in (settler(spark), None):
        numbers = [r["source_row"] for r in with_parent_flags(frame, spec, twice, value, settle).collect()]
        assert sorted(numbers) == [2, 2, 3, 4, 5]
    # A missing key that nobody has read yet is no parent's either.
    assert flags(with_parent_flags(frame, spec, parents(spark), F.col, settler(spark)))[4] == (False, False)


def test_a_field_is_read_alone_as_with_the_others(spark):
    for table, row in {"orders": (" o1", "c7", "11/28/2025", " Web", "x"), "order_lines": ("l1", "o", "p", "3.0", "$ 1,000.5", "4%")}.items():
        spec = CONFIG.table(table)
        for config in (CONFIG, CONFIG.with_(dialect="sql")):
            frame = raw(spark, table, row)
            alone = frame.select(*[field_value(spec, c, config).alias(c) for c in spec.columns]).first()
            assert alone == read_fields(frame, spec, config).select(*spec.columns).first()


def test_cumulative_bound_meets_only_lines_that_exceed(spark):
    stored = {}
    rows = raw(spark, "returns", event(11, 5), event(12, 4), event(13, 1, line="L9"))
    labelled = clean_table(rows, CONFIG.table("returns"), parents(spark), CONFIG, lambda name, frame: stored.setdefault(name, frame))
    assert [r["_over"] for r in stored["exceeded_lines"].collect()] == ["L640219"]
    assert [d for d, _ in outcome(labelled).values()] == ["Rejected"] * 3
    assert not any(c.startswith(("_t_", "_n_")) for c in stored["checked_returns"].columns)

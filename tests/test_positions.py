"""Row numbers by place: unique for rows of any content, the same in every evaluation."""

from collections import Counter

from pyspark.sql import functions as F

from tallyforge.sources import lake
from tallyforge.sources.positions import ROW_BITS, with_position


def test_rows_of_several_files(spark, tmp_path):
    # Equal rows only: nothing but the place tells them apart.
    path = str(tmp_path / "a table.parquet")
    spark.sql("SELECT 7 AS x FROM range(0, 5000, 1, 3)").write.parquet(path)
    rows = with_position(spark.read.parquet(path))
    assert rows.columns == ["x", "position"]
    first, again = ([r["position"] for r in rows.collect()] for _ in range(2))
    assert len(set(first)) == 5000 and sorted(first) == sorted(again)
    sizes = Counter(p >> ROW_BITS for p in first)
    assert sorted(sizes) == [0, 1, 2]
    assert {f: max(p & ((1 << ROW_BITS) - 1) for p in first if p >> ROW_BITS == f) + 1 for f in sizes} == sizes


def test_rows_of_one_file_and_of_none(spark, tmp_path):
    path = str(tmp_path / "one.parquet")
    spark.range(100, numPartitions=1).write.parquet(path)
    rows = with_position(spark.read.parquet(path), "at")
    assert rows.filter("id >= 90").filter("id <> at").count() == 0 and rows.count() == 100
    none = str(tmp_path / "none.parquet")
    spark.range(0).write.parquet(none)
    assert with_position(spark.read.parquet(none)).count() == 0


def test_the_dirty_view_needs_no_shuffle_and_no_room_for_repeats(spark, tmp_path):
    # A third of all lines are one order's, with one and the same line number.
    line = (
        "SELECT CAST(IF(id % 3 = 0, 1, id) AS BIGINT) AS l_orderkey, 5L AS l_partkey, 6L AS l_suppkey, IF(id % 3 = 0, 9, 1) AS l_linenumber,"
        " 2D AS l_quantity, 10D AS l_extendedprice, 0D AS l_discount, TIMESTAMP_NTZ'1999-01-01 00:00:00' AS l_shipdate, 'R' AS l_returnflag"
        " FROM range(0, 15000, 1, 4)"
    )
    spark.sql(line).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name, columns in {
        "nation": "1 AS n_nationkey, 1 AS n_regionkey", "region": "1 AS r_regionkey, 'ASIA' AS r_name",
        "customer": "1L AS c_custkey, 'a' AS c_name, 1 AS c_nationkey, 'BUILDING' AS c_mktsegment",
        "part": "1L AS p_partkey, 'a' AS p_name, 'b' AS p_type, 'Brand#7' AS p_brand, 1D AS p_retailprice",
        "orders": "1L AS o_orderkey, 1L AS o_custkey, 'O' AS o_orderstatus, TIMESTAMP_NTZ'1999-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority",
    }.items():
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    raw = lake.raw_tables(spark, str(tmp_path))
    for name in ("order_lines", "returns"):
        rows = raw[name]
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Window" not in plan
        assert rows.agg(F.count("*") - F.count_distinct("source_row")).first()[0] == 0
        assert rows.filter("source_row < 2").count() == 0


def test_long_keys_stay_whole(spark):
    key = spark.sql(f"SELECT {lake.padded('C', 'k')} AS code FROM VALUES (7L), (1234567890123456L) t(k)")
    assert [r["code"] for r in key.collect()] == ["C000000000007", "C1234567890123456"]


def test_row_numbers_follow_from_the_data(spark, tmp_path):
    # Equal rows in files that are cut and ordered in two ways; orders 1 and 3 hold a line twice, one key is null.
    line = (
        "SELECT k AS l_orderkey, CAST(p AS BIGINT) AS l_partkey, 6L AS l_suppkey, 1 AS l_linenumber, 2D AS l_quantity, 10D AS l_extendedprice,"
        " 0D AS l_discount, TIMESTAMP_NTZ'1999-01-01 00:00:00' AS l_shipdate, 'R' AS l_returnflag"
        " FROM VALUES (3L, 5), (1L, 7), (2L, 4), (1L, 2), (3L, 5), (NULL, 1) t(k, p)"
    )
    numbers = []
    for name, order, files in (("a", "p", 1), ("b", "p DESC", 3)):
        path = str(tmp_path / name)
        spark.sql(line).orderBy(F.expr("l_partkey") if order == "p" else F.expr("l_partkey").desc()).repartition(files).write.parquet(f"{path}/lineitem.parquet")
        rows = lake.numbered_lines(spark, path).select("l_orderkey", "l_partkey", "position").collect()
        numbers.append(sorted((r["position"], r["l_orderkey"], r["l_partkey"]) for r in rows))
    assert numbers[0] == numbers[1] == [(0, None, 1), (1, 1, 2), (2, 1, 7), (3, 2, 4), (4, 3, 5), (5, 3, 5)]

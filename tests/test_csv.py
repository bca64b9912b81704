import pytest
from pyspark.sql import functions as F

from tallyforge.sources import csv

COLUMNS = ["a", "b"]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def read(frame):
    return [tuple(r) for r in frame.drop("record").orderBy("source_row").collect()]


def test_cells_stay_text_and_records_are_numbered(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n1,  padded \n"two ""quoted""","line\nbreak"\n,\n007,"x,y"\n')
    assert read(csv.scan(spark, path, COLUMNS)) == [
        ("1", "  padded ", 2, False), ('two "quoted"', "line\nbreak", 3, False), (None, None, 4, False), ("007", "x,y", 5, False)]


def test_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "t.csv", b"\xef\xbb\xbfa,b\n1,2\n")
    assert read(csv.scan(spark, path, COLUMNS)) == [("1", "2", 2, False)]


def test_ragged_records_are_flagged(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n1,2\n3\n4,5,6\n7,8\n")
    assert [(n, bad) for *_, n, bad in read(csv.scan(spark, path, COLUMNS))] == [(2, False), (3, True), (4, True), (5, False)]


def test_ragged_records_keep_their_text(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n1,2\n4,5,6\n")
    assert [r["record"] for r in csv.scan(spark, path, COLUMNS).orderBy("source_row").collect()] == [None, "4,5,6"]


def test_headers_of_further_files_are_checked(spark, tmp_path):
    write(tmp_path / "t.csv" / "1.csv", "a,b\n1,2\n")
    write(tmp_path / "t.csv" / "2.csv", "b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        csv.scan(spark, str(tmp_path / "t.csv"), COLUMNS, quoted_newlines=False).collect()


def test_blank_lines_read_alike_in_both_modes(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n1,2\n   \n\n"3,4",5\n6\n')
    both = [read(csv.scan(spark, path, COLUMNS, quoted_newlines=m)) for m in (True, False)]
    assert both[0] == both[1]
    assert [(n, bad) for *_, n, bad in both[0]] == [(2, False), (3, True), (4, False), (5, True)]


@pytest.mark.parametrize("header,message", [("b,a", "unexpected header"), ("a", "unexpected header"), ("a,b,source_row", "source_row")])
def test_wrong_headers_are_errors(spark, tmp_path, header, message):
    path = write(tmp_path / "t.csv", header + "\n1,2\n")
    with pytest.raises(csv.HeaderError, match=message):
        csv.scan(spark, path, COLUMNS)


def test_empty_input_is_an_error(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n")
    with pytest.raises(csv.EmptyInputError):
        csv.stage({"t": csv.scan(spark, path, COLUMNS)}, str(tmp_path / "staged"), spark)


def test_numbers_run_over_files_and_splits(spark, tmp_path):
    folder = tmp_path / "t.csv"
    total = 0
    for part in range(3):
        body = "".join(f"{part}-{i},{'y' * (i % 17)}\n" for i in range(2000 + part))
        write(folder / f"part-{part}.csv", "a,b\n" + body)
        total += 2000 + part
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        rows = csv.scan(spark, str(folder), COLUMNS, quoted_newlines=False)
        assert rows.select(F.spark_partition_id()).distinct().count() > 3
        got = read(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [n for *_, n, _ in got] == list(range(2, total + 2))
    assert [a for a, *_ in got] == [f"{part}-{i}" for part in range(3) for i in range(2000 + part)]


def test_written_files_keep_a_header_when_empty(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    csv.write_csv(spark.createDataFrame([], "a STRING, b STRING"), path)
    assert spark.read.option("header", True).csv(path).columns == COLUMNS

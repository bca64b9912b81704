from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import dates, numbers, sql, text


def apply(spark, build, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r["x"] for r in rows.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_dates_take_two_layouts_only(spark):
    good = ["09/14/2024", "2024-09-14"]
    bad = ["14/09/2024", "2024-06-31", "14 Sep 2024", "2024-9-14", "", "2024-09-14\n", "20240914"]
    assert apply(spark, dates.explicit_date, good) == [date(2024, 9, 14)] * 2
    assert apply(spark, dates.explicit_date, bad) == [None] * len(bad)


def test_numbers_rates_and_currency(spark):
    assert apply(spark, numbers.percent, ["35%", "0.35", "35 %", "+8%"]) == [D("0.35"), D("0.35"), D("0.35"), D("0.08")]
    assert apply(spark, numbers.currency, ["$6,071.25", "6071.25", "$ 9", "-4"]) == [D("6071.25"), D("6071.25"), D(9), D(-4)]
    bad = ["60,71.25", "Infinity", "n/a", ".25", "8.", "$$3", "2e5", "4 4", "", "31\n"]
    assert apply(spark, numbers.currency, bad) == [None] * len(bad)


def test_lenient_numbers(spark):
    assert apply(spark, numbers.us_number_lenient, ["60,71.25", ".25", "8.", "9-", "-9"]) == [D("6071.25"), D("0.25"), D(8), D(-9), D(-9)]
    assert apply(spark, numbers.us_number_lenient, ["", "-", ",4", "3.4.5", "-9-", "q"]) == [None] * 6


def test_whole_counts(spark):
    read = lambda v: numbers.whole_count(numbers.us_number(v))
    assert apply(spark, read, ["6.0", "4,000", "0.0", "-7", "3.25", "88888888888"]) == [6, 4000, None, None, None, None]


def test_model_precision(spark):
    fits = lambda v: numbers.fits(numbers.us_number(v), numbers.MONEY)
    assert apply(spark, fits, ["48.70", "48.704", "77777777777.77", "3.000"]) == [True, False, False, True]


def test_long_numbers_are_never_rounded(spark):
    fits = lambda v: numbers.fits(numbers.us_number(v), numbers.MONEY)
    values = ["5.0000000000000000000001", "5.00000000000000000000000", "0000000000000000000000005.10", "444444444444444444444444", "-0.00000000000000000009", "0.9999999999999999999999"]
    assert apply(spark, fits, values) == [False, True, True, False, False, False]
    sign = lambda v: F.signum(numbers.us_number(v)).cast("int")
    assert apply(spark, sign, values) == [1, 1, 1, 1, -1, 1]
    rate = lambda v: numbers.fits(numbers.percent(v), numbers.RATE)
    assert apply(spark, rate, ["35.00000000000000001%", "35.0000000000000000000%", "35.000000000000000000001%", "35%"]) == [False, True, False, True]


def test_title_case_breaks_at_every_non_letter(spark):
    values = ["middle east", "o'neil-x", "  two  blanks", "ÉCOLE 2nd", "a1b", ""]
    assert apply(spark, text.title_case, values) == [v.title() for v in values]


def test_first_upper(spark):
    assert apply(spark, text.first_upper, ["hOME oFFICE", "x"]) == ["Home office", "X"]


def test_strip_knows_every_blank(spark):
    values = ["\t a b \n", " x　", "\x1cz\x1f", "", None]
    assert apply(spark, text.strip, values) == ["a b", "x", "z", "", ""]
    assert apply(spark, text.clean_text, [" ", "\t", None, " q "]) == [None, None, None, "q"]


@pytest.mark.parametrize("value,ok", [("K9042", True), ("K902", False), ("K-902", False), ("É9042", True), ("K9042\n", False)])
def test_identifiers(spark, value, ok):
    assert apply(spark, lambda v: text.is_identifier(v, 5), [value]) == [ok]


def test_json_keeps_nulls(spark):
    row = spark.createDataFrame([("a", None)], "x STRING, y STRING").select(text.row_json(["x", "y"]).alias("j"))
    row = row.select("j", text.json_field(F.col("j"), "x").alias("x"), text.is_json(F.col("j")).alias("ok"))
    assert tuple(row.first()) == ('{"x":"a","y":null}', "a", True)


def test_sql_functions(spark):
    sql.register(spark)
    row = spark.sql("SELECT clean_text('\t  ') a, explicit_date(' 09/14/2024') b, us_number('6,071.5') c, us_number('60,71') d, us_number('9-') e, us_number('.25') f, us_number('3.4.5') g").first()
    assert tuple(row) == (None, date(2024, 9, 14), D("6071.5"), D(6071), D(-9), D("0.25"), None)


def test_ratios_and_tolerance(spark):
    row = spark.sql("SELECT CAST(1 AS DECIMAL(10,6)) a, CAST(0 AS DECIMAL(10,6)) z, CAST(1.000001 AS DECIMAL(10,6)) b").select(
        numbers.ratio(F.col("a"), F.col("z")).alias("r"), numbers.ratio_or_zero(F.col("a"), F.col("z")).alias("q"),
        numbers.within(F.col("a"), F.col("b")).alias("near"), numbers.within(F.col("a"), F.col("z")).alias("far")).first()
    assert (row["r"], row["q"], row["near"], row["far"]) == (None, 0, True, False)

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tables import CONFIG, CUSTOMER, LINE, PRODUCT, event, outcome, parents, raw
from tallyforge.operators import audit
from tallyforge.operators.clean import clean_table
from tallyforge.sources import csv


@pytest.fixture
def config():
    return CONFIG


def clean(spark, config, table, *rows, **kw):
    return clean_table(raw(spark, table, *rows), config.table(table), kw.get("parents", parents(spark)), config)


def dispositions(labelled):
    return [d for _, (d, _) in sorted(outcome(labelled).items())]


def test_duplicates_ignore_row_number_and_case(spark, config):
    first = ("c7301", "Mona Quill", "  WEST", "business ", "")
    rows = clean(spark, config, "customers", first, CUSTOMER, first)
    assert dispositions(rows) == ["Accepted", "Duplicate", "Duplicate"]
    kept = rows.filter("disposition = 'Accepted'").first()
    assert (kept["email"], kept["region"], kept["segment"]) == (None, "West", "Business")
    assert {r["retained_source_row"] for r in rows.filter("disposition = 'Duplicate'").collect()} == {2}


def test_equal_numbers_are_equal_records(spark, config):
    rows = clean(spark, config, "products", ("P417", "Kettle", "brass", "1,048.70"), ("P417", "Kettle", "BRASS", "$ 1048.7"))
    assert dispositions(rows) == ["Accepted", "Duplicate"]


def test_copy_of_an_invalid_row_is_a_duplicate(spark, config):
    bad = ("P417", "Kettle", "brass", "ask us")
    rows = clean(spark, config, "products", bad, bad)
    assert outcome(rows)[2] == ("Rejected", "list_price: invalid US-locale decimal")
    assert outcome(rows)[3][0] == "Duplicate"


def test_conflicting_keys_leave_together_even_with_an_invalid_twin(spark, config):
    rows = clean(spark, config, "customers", CUSTOMER, ("c7301", "Ivo Brandt", "Moon", "Consumer", ""), ("C7302", "Lena Ott", "North", "Consumer", ""))
    got = outcome(rows)
    assert got[2] == ("Rejected", "customer_id: conflicting business records for key")
    assert got[3][1] == "region: unrecognized value; customer_id: conflicting business records for key"
    assert got[4][0] == "Accepted"


def test_missing_keys_form_one_group(spark, config):
    rows = clean(spark, config, "customers", ("", "A", "East", "Consumer", ""), (" ", "B", "East", "Consumer", ""))
    expected = "customer_id: required field missing; customer_id: invalid text identifier; customer_id: conflicting business records for key"
    assert {r for _, r in outcome(rows).values()} == {expected}
    assert rows.filter("business_key IS NULL").count() == 2


def test_same_order_and_product_on_two_lines(spark, config):
    assert dispositions(clean(spark, config, "order_lines", LINE, ("L640220", *LINE[1:]))) == ["Accepted", "Accepted"]


def test_line_reasons(spark, config):
    rows = clean(
        spark, config, "order_lines",
        ("L640231", "O70000", "P417", "3", "7.20", "0"), ("L640232", "O58213", "P888", "3", "7.20", "0"), ("L640233", "O58213", "P417", "-6", "7.20", "0"),
        ("L640234", "O58213", "P417", "3", "n/a", "0"), ("L640235", "O58213", "P417", "3", "7.20", "2.25"), ("L640236", "O58213", "P417", "3", "0.00", "35%"),
        ("L64", "O58213", "P417", "3", "7.204", "0.06125"),
    )
    assert [r for _, (_, r) in sorted(outcome(rows).items())] == [
        "order_id: unknown or rejected order",
        "product_id: unknown or rejected product",
        "quantity: quantity must be a positive integer",
        "unit_price: invalid US-locale decimal",
        "discount_rate: outside [0,1]",
        "unit_price: price must be positive",
        "order_line_id: invalid text identifier; unit_price: outside the model precision; discount_rate: outside the model precision",
    ]


def test_orders_are_read_and_windowed(spark, config):
    rows = clean(
        spark, config, "orders",
        ("O58213", "C7301", "11/28/2025", " Web", "completed "), ("O58214", "C7301", "2025-04-31", "store", "Cancelled"),
        ("O58215", "C7999", "2023-08-08", "Fax", "Pending"), ("O58216", "C7301", "", "Store", "Completed"),
    )
    got = outcome(rows)
    first = rows.filter("source_row = 2").first()
    assert (first["order_date"], first["channel"], first["status"]) == (date(2025, 11, 28), "Online", "Completed")
    assert got[3] == ("Rejected", "order_date: impossible calendar date")
    assert got[4][1] == (
        "channel: unrecognized value; status: unrecognized value; order_date: outside 2025; customer_id: unknown or rejected customer"
    )
    assert got[5][1] == "order_date: required field missing; order_date: date must be ISO YYYY-MM-DD or US MM/DD/YYYY"


def test_large_single_return_spares_its_sibling(spark, config):
    got = outcome(clean(spark, config, "returns", event(11, 7), event(12, 40)))
    assert got[2][0] == "Accepted"
    assert got[3] == ("Rejected", "return_quantity: event exceeds purchased quantity")


def test_cumulative_excess_rejects_the_group(spark, config):
    got = outcome(clean(spark, config, "returns", event(11, 5), event(12, 4)))
    assert all(d == "Rejected" and "cumulative valid events" in r for d, r in got.values())


def test_copies_do_not_count_twice(spark, config):
    got = outcome(clean(spark, config, "returns", event(11, 6), event(11, 6)))
    assert [got[2][0], got[3][0]] == ["Accepted", "Duplicate"]


def test_return_dates_and_parents(spark, config):
    rows = clean(
        spark, config, "returns",
        event(11, 1, "2025-05-30"), event(12, 1, "2026-03-02"), event(13, 1, "01/29/2026"), event(14, 1, line="L111111"), event(15, 1, "soon"),
    )
    assert [r for _, (_, r) in sorted(outcome(rows).items())] == [
        "return_date: precedes order date",
        "return_date: after 2026-01-30 cutoff",
        None,
        "order_line_id: unknown or rejected line",
        "return_date: date must be ISO YYYY-MM-DD or US MM/DD/YYYY",
    ]
    void = clean(spark, config, "returns", event(11, 1), parents=parents(spark, status="Cancelled"))
    assert outcome(void)[2][1] == "order_id: return requires completed order"


def test_sql_dialect(spark):
    config = CONFIG.with_(dialect="sql")
    rows = clean(spark, config, "customers", CUSTOMER, CUSTOMER, ("C41", "Bea", " south", "CONSUMER", " Bea@Shop.org "), ("C42", "", "Moon", "Business", ""))
    got = outcome(rows)
    assert got[2] == ("Accepted", None)
    assert got[3] == ("Duplicate", "Exact duplicate of original business fields")
    assert rows.filter("source_row = 4").first()["email"] == "Bea@Shop.org"
    assert got[5] == ("Rejected", "Missing or overlength customer name")
    # Padding makes raw cells differ, so the pair conflicts instead of matching.
    pair = outcome(clean(spark, config, "customers", CUSTOMER, ("C7301", "Mona Quill", " west ", "Business", "")))
    assert {r for _, r in pair.values()} == {"Conflicting records share a normalized business key"}
    price = clean(spark, config, "products", ("P51", "Nib", "gARDEN tools", "$4,71.30$"), ("P52", "Nib", "ink", "6.125"))
    assert price.filter("source_row = 2").select("category", "list_price").first() == ("Garden tools", D("471.30"))
    assert outcome(price)[3][1] == "List price is outside the model precision"


def test_ragged_rows_are_rejected(spark, config):
    rows = raw(spark, "products", PRODUCT, ("P418", "Stool", None, None)).withColumn("ragged", F.col("source_row") == 3)
    got = outcome(clean_table(rows, config.table("products"), {}, config))
    assert got[2][0] == "Accepted"
    assert got[3][1].startswith("record: field count differs from header")


@pytest.mark.parametrize("dialect", ["canonical", "sql"])
@pytest.mark.parametrize("whole_files", [True, False])
def test_a_ragged_record_does_not_swallow_its_twin(spark, config, tmp_path, dialect, whole_files):
    lines = ["C7301,Mona Quill,West,Business,m@q.org,EXTRA", "C7301,Mona Quill,West,Business,m@q.org", "C7400,Short One,West", "C7400,Short One,West,Business,"]
    path = tmp_path / "customers.csv"
    path.write_text("customer_id,customer_name,region,segment,email\n" + "\n".join(lines) + "\n")
    config = config.with_(dialect=dialect)
    rows = csv.scan(spark, str(path), config.table("customers").columns, quoted_newlines=whole_files)
    got = outcome(clean_table(rows, config.table("customers"), {}, config))
    assert [got[n][0] for n in (2, 3, 4, 5)] == ["Rejected", "Accepted", "Rejected", "Accepted"]
    assert "field count" in got[2][1]


TOO_FINE = ["10.0000000000000000001", "0.0000000000000000001", "99999999999.99", "123456789012345678901.5", "7.005"]


def test_money_is_never_rounded(spark, config):
    rows = clean(spark, config, "products", *[(f"P5{i:02}", "Pin", "x", v) for i, v in enumerate(TOO_FINE)])
    assert {r for _, r in outcome(rows).values()} == {"list_price: outside the model precision"}
    free = clean(spark, config.with_(enforce_precision=False), "products", *[(f"P5{i:02}", "Pin", "x", v) for i, v in enumerate(TOO_FINE)])
    kept = {r["source_row"]: r["list_price"] for r in free.filter("disposition = 'Accepted'").collect()}
    assert None not in kept.values() and (kept[4], kept[6]) == (D("99999999999.99"), D("7.005"))


def test_numbers_beyond_the_reader_are_told_apart(spark, config):
    rows = clean(spark, config, "products", ("P601", "Pin", "x", "1.0000000000000000001"), ("P601", "Pin", "x", "1.0000000000000000002"))
    assert {r.split("; ")[-1] for _, r in outcome(rows).values()} == {"product_id: conflicting business records for key"}


def test_quality_and_log(spark, config):
    rows = clean(spark, config, "customers", CUSTOMER, CUSTOMER, ("C7302", "", "South", "Business", ""))
    line = audit.quality_summary({"customers": rows}).first()
    assert tuple(line) == ("customers", 3, 1, 1, 1, True)
    log = audit.disposition_log({"customers": rows})
    assert log.filter("disposition = 'Rejected'").first()["raw_json"] == (
        '{"customer_id":"C7302","customer_name":"","region":"South","segment":"Business","email":""}'
    )
    assert audit.rejected_rows(rows, config.table("customers")).columns[-2:] == ["source_row", "rejection_reason"]

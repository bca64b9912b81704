"""End to end on a hand-made delivery."""

import hashlib
import json

import pytest

from tables import CONFIG
from tallyforge.plans.checks import ValidationError
from tallyforge.plans.run import run

FILES = {
    "customers": "customer_id,customer_name,region,segment,email\nC0001,Ann, east ,CONSUMER,\nC0002,Bob,West,Business,B@x.com\nC0001,Ann,East,Consumer,\n",
    "products": "product_id,product_name,category,list_price\nP001,Lamp,lighting,$50.00\nP002,Desk,furniture,\"1,200.00\"\n",
    "orders": "order_id,customer_id,order_date,channel,status\nO00001,C0001,2025-01-10, web ,Completed\nO00002,C0002,02/15/2025,Retail, COMPLETED \n"
              "O00003,C0002,2025-02-16,Store,Cancelled\nOX0001,C0001,2025-02-30,Store,Completed\n",
    "order_lines": "order_line_id,order_id,product_id,quantity,unit_price,discount_rate\nL000001,O00001,P001,4,50.00,10%\nL000002,O00002,P002,1,\"$1,200.00\",0\n"
                   "L000003,O00003,P001,2,50.00,0.00\nX000001,O99999,P001,1,50.00,0.00\n",
    "returns": "return_id,order_line_id,return_date,return_quantity,reason\nR00001,L000001,2025-01-20,1,not needed\nR00002,L000001,01/21/2025,1,damaged\n"
               "RX001,L000001,2025-01-22,999,damaged\n",
}
EXPECTED = {
    "clean_rows": {"customers": 2, "products": 2, "orders": 3, "order_lines": 3, "returns": 2},
    "duplicate_rows_removed": {"customers": 1, "products": 0, "orders": 0, "order_lines": 0, "returns": 0},
    "rejected_rows": {"customers": 0, "products": 0, "orders": 1, "order_lines": 1, "returns": 1},
    "completed_orders": 2, "gross_sales": "1400.00", "discounts": "20.00", "refunds": "90.00", "net_sales": "1290.00",
    "aov": "645", "sold_units": 5, "returned_units": 2,
}


@pytest.fixture(scope="module")
def delivery(tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivery")
    (folder / "raw").mkdir()
    for name, body in FILES.items():
        (folder / "raw" / f"{name}.csv").write_text(body)
    (folder / "expected.json").write_text(json.dumps(EXPECTED))
    return folder


def digest(folder):
    return {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.glob("*.csv")}


def content(spark, folder, kind, name):
    frame = getattr(spark.read, kind)(f"{folder}/{name}")
    return sorted(map(str, frame.collect()))


def test_run_is_repeatable_and_checked(spark, delivery):
    before = digest(delivery / "raw")
    out = str(delivery / "out")
    first = run(spark, str(delivery / "raw"), out, CONFIG, expectations=str(delivery / "expected.json"))
    assert first.checks.filter("NOT passed").count() == 0
    assert first.checks.filter("check LIKE 'benchmark_%'").count() == 23
    names = [("json", "analysis/summary"), ("json", "checks/source_manifest"), ("parquet", "analysis/product_summary"), ("parquet", "labelled/returns")]
    snapshot = {n: content(spark, out, k, n) for k, n in names}
    run(spark, str(delivery / "raw"), out, CONFIG, expectations=str(delivery / "expected.json"))
    assert snapshot == {n: content(spark, out, k, n) for k, n in names}
    assert before == digest(delivery / "raw")

    rejected = spark.read.option("header", True).csv(f"{out}/rejected/returns.csv").collect()
    assert [(r["return_id"], r["rejection_reason"]) for r in rejected] == [
        ("RX001", "return_id: invalid text identifier; return_quantity: event exceeds purchased quantity")]
    assert spark.read.option("header", True).csv(f"{out}/rejected/duplicates_orders.csv").columns[-1] == "rejection_reason"
    summary = spark.read.json(f"{out}/analysis/summary").first()
    assert summary["findings"]["top_category"]["member"] == "Furniture"
    manifest = {r["table"]: r for r in spark.read.json(f"{out}/checks/source_manifest").collect()}
    assert manifest["orders"]["sha256"] == before["orders.csv"] and manifest["orders"]["raw_rows"] == 4


def test_wrong_expectation_fails_the_run(spark, delivery):
    wrong = delivery / "wrong.json"
    wrong.write_text(json.dumps({**EXPECTED, "net_sales": "1.00"}))
    with pytest.raises(ValidationError, match="benchmark_net_sales"):
        run(spark, str(delivery / "raw"), str(delivery / "out2"), CONFIG, expectations=str(wrong))


def test_output_must_not_be_the_raw_folder(spark, delivery):
    with pytest.raises(ValueError, match="differ"):
        run(spark, str(delivery / "raw"), str(delivery / "raw") + "/", CONFIG)

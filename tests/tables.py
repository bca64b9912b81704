"""Small hand-made tables and brute-force helpers for the tests."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from tallyforge.config import RETAIL_2025 as CONFIG

CUSTOMER = ("C7301", "Mona Quill", "West", "Business", "")
PRODUCT = ("P417", "Brass Kettle", "Kitchen", "48.75")
ORDER = ("O58213", "C7301", "2025-06-09", "Store", "Completed")
LINE = ("L640219", "O58213", "P417", "8", "48.75", "0.04")


def raw(spark, table, *rows):
    """Text rows numbered from 2 in the given order."""
    columns = CONFIG.table(table).columns
    schema = ", ".join(f"{c} STRING" for c in columns) + ", source_row BIGINT"
    return spark.createDataFrame([(*r, n) for n, r in enumerate(rows, 2)], schema)


def parents(spark, *, status="Completed"):
    customers = spark.createDataFrame([("C7301", "Mona Quill", "West", "Business", None, 2)],
                                      "customer_id STRING, customer_name STRING, region STRING, segment STRING, email STRING, source_row BIGINT")
    products = spark.createDataFrame([("P417", "Brass Kettle", "Kitchen", D("48.75"), 2)],
                                     "product_id STRING, product_name STRING, category STRING, list_price DECIMAL(12,2), source_row BIGINT")
    orders = spark.createDataFrame([("O58213", "C7301", date(2025, 6, 9), "Store", status, 2)],
                                   "order_id STRING, customer_id STRING, order_date DATE, channel STRING, status STRING, source_row BIGINT")
    lines = spark.createDataFrame([("L640219", "O58213", "P417", 8, D("48.75"), D("0.0400"), 2)],
                                  "order_line_id STRING, order_id STRING, product_id STRING, quantity INT, unit_price DECIMAL(12,2), discount_rate DECIMAL(5,4), source_row BIGINT")
    return {"customers": customers, "products": products, "orders": orders, "order_lines": lines}


def event(number, quantity, day="2025-07-17", line="L640219"):
    return (f"R{number:05d}", line, day, str(quantity), "Wrong colour")


def outcome(labelled):
    """source_row -> (disposition, reason)."""
    return {r["source_row"]: (r["disposition"], r["rejection_reason"]) for r in labelled.collect()}

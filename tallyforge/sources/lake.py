"""The order-management lake (region, nation, customer, part, orders, lineitem) seen as retail tables.

Two views are offered. ``model_tables`` gives the clean, typed model. ``raw_tables`` gives the same
business as badly typed text: padding, mixed case, currency signs, percentages, US dates, impossible
values, unknown parents, copies and key conflicts, spread over the whole tables by key.

The projections are plain SQL expressions that any ANSI engine reads the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, retail_tables
from ..operators.scan import number_values

# The words of the lake's schema.
LAKE_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
LAKE_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _tables(word):
    regions, segments = tuple(map(word, LAKE_REGIONS)), tuple(map(word, LAKE_SEGMENTS))
    return retail_tables(regions=regions, segments=segments, id_lengths=(13, 13, 13, 14, 15))


# Seven calendar years; the last months hold no order, which exercises gap filling.
LAKE_CONFIG = RunConfig(
    tables=_tables(str),
    order_from=date(1995, 1, 1),
    order_before=date(2002, 1, 1),
    return_cutoff=date(2001, 8, 31),
)
# The dirty view is cleaned to title case and against a shorter window, so that late orders fall outside.
LAKE_DIRTY_CONFIG = LAKE_CONFIG.with_(
    tables=_tables(str.title), order_before=date(2001, 1, 1), return_cutoff=date(2001, 1, 30)
)

LINE_ID = (
    "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),"
    " CAST(l_suppkey AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING))"
)
QUANTITY = "CAST(l_quantity AS INT)"
CENTS = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)"
EVENT_UNITS = "1 + CAST((l_orderkey + l_linenumber) % 5 AS INT)"
REASON = "CASE l_suppkey % 3 WHEN 0 THEN 'Damaged' WHEN 1 THEN 'Not Needed' ELSE 'Wrong Item' END"


def unit_price(int_div: str) -> str:
    """Whole cents per unit; ``int_div`` is the engine's integer division operator."""
    return (
        f"CAST(CAST({CENTS} {int_div} CAST(l_quantity AS BIGINT) AS DECIMAL(12,0))"
        " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"
    )


def read(spark: SparkSession, sf_dir: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """One lake table, read where it lies."""
    frame = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return frame if columns is None else frame.select(*columns)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_discount", "l_shipdate",
]


# ---------------------------------------------------------------- clean model

CUSTOMER_MODEL = [
    "c_custkey AS customer_id",
    "c_name AS customer_name",
    "r_name AS region",
    "c_mktsegment AS segment",
    "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('c', CAST(c_custkey AS STRING), '@example.com') END AS email",
]
PRODUCT_MODEL = [
    "p_partkey AS product_id",
    "p_name AS product_name",
    "p_type AS category",
    "CAST(p_retailprice AS DECIMAL(12,2)) AS list_price",
]
ORDER_MODEL = [
    "o_orderkey AS order_id",
    "o_custkey AS customer_id",
    "CAST(o_orderdate AS DATE) AS order_date",
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online' ELSE 'Store' END AS channel",
    "CASE WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Completed' END AS status",
]


def line_model(int_div: str) -> list[str]:
    return [
        f"{LINE_ID} AS order_line_id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        f"{QUANTITY} AS quantity",
        f"{unit_price(int_div)} AS unit_price",
        "CAST(l_discount AS DECIMAL(5,4)) AS discount_rate",
    ]


def event_model(event: str) -> list[str]:
    """Return events of one line: the first takes up to five units, a second takes one unit that is
    left. ``event`` names the running event number (1 or 2)."""
    return [
        f"concat({LINE_ID}, '-', CAST({event} AS STRING)) AS return_id",
        f"{LINE_ID} AS order_line_id",
        "CAST(l_shipdate AS DATE) AS return_date",
        f"CASE WHEN {event} = 1 THEN least({EVENT_UNITS}, {QUANTITY}) ELSE 1 END AS return_quantity",
        f"{REASON} AS reason",
    ]


SECOND_EVENT = f"(l_partkey % 3 = 0 AND {EVENT_UNITS} < {QUANTITY})"


def model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five clean tables. Nation and region are fixed lists of the schema, not growing data; their
    joins carry no hint and are sized by Spark."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    placed = (
        read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lineitem = read(spark, sf_dir, "lineitem", [*LINE_COLUMNS, "l_returnflag"])
    returned = lineitem.filter("l_returnflag = 'R'").selectExpr(
        "*", f"explode(CASE WHEN {SECOND_EVENT} THEN array(1, 2) ELSE array(1) END) AS event"
    )
    return {
        "customers": placed.selectExpr(*CUSTOMER_MODEL),
        "products": read(spark, sf_dir, "part").selectExpr(*PRODUCT_MODEL),
        "orders": read(spark, sf_dir, "orders", ORDER_COLUMNS).selectExpr(*ORDER_MODEL),
        "order_lines": lineitem.selectExpr(*line_model("div")),
        "returns": returned.selectExpr(*event_model("event")),
    }


# ---------------------------------------------------------------- dirty text


def padded(letter: str, key: str, digits: int = 12) -> str:
    """A letter and a key of at least ``digits`` digits; longer keys keep all of theirs."""
    text = f"CAST({key} AS STRING)"
    return f"concat('{letter}', lpad({text}, greatest(CAST(length({text}) AS INT), {digits}), '0'))"


def _us(day: str) -> str:
    iso = f"CAST({day} AS STRING)"
    return f"concat(substr({iso}, 6, 2), '/', substr({iso}, 9, 2), '/', substr({iso}, 1, 4))"


CUSTOMER_ID = padded("C", "c_custkey")
CUSTOMER_RAW = [
    "c_custkey * 2 + 2 + copy AS source_row",
    f"CASE c_custkey % 11 WHEN 1 THEN concat(' ', lower({CUSTOMER_ID})) WHEN 2 THEN concat({CUSTOMER_ID}, ' ')"
    f" ELSE {CUSTOMER_ID} END AS customer_id",
    "CASE WHEN c_custkey % 53 = 5 THEN '' WHEN c_custkey % 10 = 3 THEN concat(c_name, '  ') ELSE c_name END"
    " AS customer_name",
    "CASE WHEN c_custkey % 37 = 3 THEN 'ATLANTIS' WHEN copy = 1 THEN concat(' ', lower(r_name), ' ') ELSE r_name END"
    " AS region",
    "CASE WHEN c_custkey % 41 = 7 THEN '' ELSE lower(c_mktsegment) END AS segment",
    "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('C', CAST(c_custkey AS STRING), '@Example.COM ') END AS email",
]
CUSTOMER_COPIES = "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END"

PRODUCT_PRICE = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)"
PRODUCT_RAW = [
    "p_partkey * 2 + 2 + copy AS source_row",
    f"CASE p_partkey % 61 WHEN 4 THEN 'P-1' ELSE {padded('P', 'p_partkey')} END AS product_id",
    "CASE WHEN copy = 1 THEN upper(p_name) ELSE p_name END AS product_name",
    "CASE p_partkey % 6 WHEN 1 THEN lower(p_type) WHEN 2 THEN concat(p_type, ' o''neil-x') ELSE p_type END AS category",
    f"CASE p_partkey % 29 WHEN 1 THEN concat('$', {PRODUCT_PRICE}) WHEN 2 THEN 'unknown' WHEN 3 THEN '0.00'"
    f" WHEN 4 THEN concat('$ ', {PRODUCT_PRICE}, '0') WHEN 5 THEN concat({PRODUCT_PRICE}, '5')"
    f" WHEN 6 THEN concat('-', {PRODUCT_PRICE}) ELSE {PRODUCT_PRICE} END AS list_price",
]
# A copy of a part differs in its name, which makes a key conflict, except for all-capital names.
PRODUCT_COPIES = "CASE WHEN p_brand = 'Brand#7' THEN 1 ELSE 0 END"

ORDER_DAY = "CAST(o_orderdate AS DATE)"
ORDER_RAW = [
    "o_orderkey * 2 + 2 + copy AS source_row",
    f"CASE WHEN o_orderkey % 67 = 9 THEN concat({padded('O', 'o_orderkey')}, '#') ELSE {padded('O', 'o_orderkey')} END"
    " AS order_id",
    f"CASE WHEN o_orderkey % 71 = 2 THEN 'C99999999999X' ELSE {padded('C', 'o_custkey')} END AS customer_id",
    f"CASE o_orderkey % 83 WHEN 1 THEN '1999-02-30' WHEN 2 THEN 'Feb 3 1999' WHEN 3 THEN '13/02/1999' WHEN 4 THEN ''"
    f" ELSE CASE WHEN copy = 1 OR o_orderkey % 5 = 1 THEN {_us(ORDER_DAY)} ELSE CAST({ORDER_DAY} AS STRING) END END"
    " AS order_date",
    "CASE o_orderpriority WHEN '1-URGENT' THEN ' web ' WHEN '2-HIGH' THEN 'ONLINE' WHEN '3-MEDIUM' THEN 'Retail'"
    " WHEN '4-NOT SPECIFIED' THEN 'store' ELSE CASE WHEN o_orderkey % 19 = 1 THEN 'phone' ELSE 'Store' END END AS channel",
    "CASE o_orderstatus WHEN 'P' THEN 'cancelled' WHEN 'O' THEN concat(' ', 'COMPLETED ') ELSE 'Completed' END AS status",
]
ORDER_COPIES = "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END"

# Lines are textified in two steps: parts that several columns share are named once in the base step.


# Lines may share order and line number, so what numbers a line is its ``position`` in the order of all columns
# that the view reads. It follows from the data alone: files may be cut and written in any way.
ROW_NUMBER = "position * 2 + 2"
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
    "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
]


def line_base(int_div: str) -> list[str]:
    """Shared pieces of one line. The row number leaves room for one copy."""
    return [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        f"{ROW_NUMBER} AS row_number",
        f"{padded('L', 'l_orderkey')} AS line_code",
        f"{padded('O', 'l_orderkey')} AS order_code",
        f"{padded('P', 'l_partkey')} AS product_code",
        f"CAST({QUANTITY} AS STRING) AS quantity_text",
        f"CAST({unit_price(int_div)} AS STRING) AS price_text",
        "CAST(l_discount AS DECIMAL(5,4)) AS rate",
        f"{LINE_COPIES} AS copies",
    ]


LINE_COPIES = "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END"
LINE_RAW = [
    "CAST(row_number + copy AS BIGINT) AS source_row",
    "concat(line_code, CAST(l_linenumber AS STRING)) AS order_line_id",
    "CASE WHEN l_orderkey % 73 = 8 THEN 'O99999999999X' ELSE order_code END AS order_id",
    "CASE WHEN l_partkey % 79 = 8 THEN lower(product_code) ELSE product_code END AS product_id",
    "CASE WHEN l_suppkey % 31 = 4 THEN concat('-', quantity_text) WHEN l_suppkey % 31 = 5 THEN concat(quantity_text, '.5')"
    " WHEN copy = 1 THEN concat(quantity_text, '.0') ELSE quantity_text END AS quantity",
    "CASE WHEN l_partkey % 43 = 6 THEN 'unknown' WHEN copy = 1 THEN concat(' $', price_text)"
    " WHEN l_partkey % 7 = 1 AND length(price_text) > 6 THEN concat(substr(price_text, 1, length(price_text) - 6), ',',"
    " substr(price_text, length(price_text) - 5)) ELSE price_text END AS unit_price",
    "CASE WHEN l_partkey % 47 = 6 THEN '1.50' WHEN l_linenumber = 2 THEN concat(CAST(CAST(rate * 100 AS INT) AS STRING), '%')"
    " ELSE CAST(rate AS STRING) END AS discount_rate",
]


def event_base() -> list[str]:
    """Shared pieces of the return events of one line."""
    return [
        "l_orderkey", "l_suppkey", "l_linenumber",
        f"{ROW_NUMBER} AS row_number",
        f"{padded('R', 'l_orderkey')} AS event_code",
        f"{padded('L', 'l_orderkey')} AS line_code",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS day_text",
        f"CAST({EVENT_UNITS} AS STRING) AS units_text",
        f"{REASON} AS reason_text",
        f"{EVENT_COPIES} AS copies",
    ]


# A second event on the line is another record of its own.
EVENT_COPIES = "CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END"
EVENT_RAW = [
    "CAST(row_number + copy AS BIGINT) AS source_row",
    "concat(event_code, CAST(l_linenumber AS STRING), CAST(copy AS STRING)) AS return_id",
    "concat(line_code, CAST(l_linenumber AS STRING)) AS order_line_id",
    "CASE WHEN l_suppkey % 23 = 1 THEN concat(substr(day_text, 6, 2), '/', substr(day_text, 9, 2), '/',"
    " substr(day_text, 1, 4)) ELSE day_text END AS return_date",
    "CASE WHEN l_suppkey % 37 = 1 THEN '999' ELSE units_text END AS return_quantity",
    "CASE WHEN l_suppkey % 41 = 3 THEN '' ELSE lower(reason_text) END AS reason",
]


class _Tables(Mapping):
    """Frames by name, each built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = {name: cache(build) for name, build in builders.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with their ``position`` from 0 in ``LINE_ORDER``. The sorted lines are stored, so every reader
    sees the same numbers and the table is sorted once. Lines equal in all these columns are interchangeable."""
    order = [F.col(c).asc_nulls_first() for c in LINE_ORDER]
    numbered = number_values(read(spark, sf_dir, "lineitem", LINE_ORDER), order, "number")
    return numbered.select(*LINE_ORDER, (F.col("number") - 1).alias("position"))


def raw_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The dirty text view, one row per record copy. Lines are numbered when a table of lines is asked for."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    placed = (
        read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lineitem = cache(lambda: numbered_lines(spark, sf_dir))

    def copied(frame: DataFrame, copies: str, columns: list[str]) -> DataFrame:
        return frame.selectExpr("*", f"explode(sequence(0, {copies})) AS copy").selectExpr(*columns)

    return _Tables(
        {
            "customers": lambda: copied(placed, CUSTOMER_COPIES, CUSTOMER_RAW),
            "products": lambda: copied(read(spark, sf_dir, "part"), PRODUCT_COPIES, PRODUCT_RAW),
            "orders": lambda: copied(read(spark, sf_dir, "orders", ORDER_COLUMNS), ORDER_COPIES, ORDER_RAW),
            "order_lines": lambda: copied(lineitem().selectExpr(*line_base("div")), "copies", LINE_RAW),
            "returns": lambda: copied(lineitem().filter("l_returnflag = 'R'").selectExpr(*event_base()), "copies", EVENT_RAW),
        }
    )

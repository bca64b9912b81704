"""The query registry and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import FACT_SETTINGS, tune
from ..sources import lake


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None):
    """Register a builder taking (spark, sf_dir); ``sql`` is the same result in plain SQL."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark, FACT_SETTINGS), sf_dir)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = Query(name, run, sql)
        return build

    return register


# Engines break exact ties differently and reach them through different division types. A threshold just
# above one half, applied the same way on both sides, keeps ties from deciding a digit.
_HALF = 0.5001


def settled(value, digits: int = 6):
    """A ratio as a double with ``digits`` decimals."""
    scale = float(10**digits)
    return F.floor(value.cast("double") * scale + _HALF) / scale


def settled_sql(expression: str, digits: int = 6) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(floor(({expression}) * {scale} + CAST({_HALF} AS DOUBLE)) / {scale})"


def rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({c: settled(F.col(c), digits) for c in columns})


def quotient(numerator: str, denominator: str, digits: int = 6) -> str:
    return settled_sql(f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)", digits)


def _select(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


CONFIG = lake.LAKE_CONFIG
_START, _BEFORE, _CUTOFF = CONFIG.order_from, CONFIG.order_before, CONFIG.return_cutoff
_PLACED = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"

# The clean model, its facts and the calendar as common table expressions.
MODEL_SQL = f"""
m_customers AS ({_select(lake.CUSTOMER_MODEL, _PLACED)}),
m_products AS ({_select(lake.PRODUCT_MODEL, 'part')}),
m_orders AS ({_select(lake.ORDER_MODEL, 'orders')}),
m_lines AS ({_select(lake.line_model('//'), 'lineitem')}),
m_returns AS ({_select(lake.event_model('event'), 'lineitem, (VALUES (1), (2)) e(event)')}
  WHERE l_returnflag = 'R' AND (event = 1 OR {lake.SECOND_EVENT})),
returned AS (SELECT order_line_id, CAST(sum(return_quantity) AS BIGINT) AS returned_units,
  count(*) AS return_events, max(return_date) AS latest_return_date
  FROM m_returns WHERE return_date <= DATE '{_CUTOFF}' GROUP BY order_line_id),
priced AS (SELECT l.*, coalesce(r.returned_units, 0) AS returned_units, coalesce(r.return_events, 0) AS return_events,
  r.latest_return_date,
  CAST(l.quantity * l.unit_price AS DECIMAL(28,6)) AS gross_sales,
  CAST(l.quantity * l.unit_price * l.discount_rate AS DECIMAL(28,6)) AS discounts,
  CAST(coalesce(r.returned_units, 0) * l.unit_price * (1 - l.discount_rate) AS DECIMAL(28,6)) AS refunds
  FROM m_lines l LEFT JOIN returned r ON r.order_line_id = l.order_line_id),
measured AS (SELECT *, gross_sales - discounts AS sales_before_returns, gross_sales - discounts - refunds AS net_sales FROM priced),
sold AS (SELECT order_id, customer_id, order_date, CAST(date_trunc('month', order_date) AS DATE) AS month_start, channel
  FROM m_orders WHERE status = 'Completed' AND order_date >= DATE '{_START}' AND order_date < DATE '{_BEFORE}'),
sales AS (SELECT m.order_line_id, m.order_id, s.customer_id, s.order_date, s.month_start, s.channel, m.product_id,
  p.product_name, p.category, c.region, m.quantity AS sold_units, m.returned_units, m.unit_price, m.discount_rate,
  m.gross_sales, m.discounts, m.sales_before_returns, m.refunds, m.net_sales
  FROM measured m JOIN sold s ON s.order_id = m.order_id JOIN m_products p ON p.product_id = m.product_id
  JOIN m_customers c ON c.customer_id = s.customer_id),
order_sales AS (SELECT s.order_id, s.customer_id, s.order_date, s.month_start, s.channel,
  coalesce(sum(m.gross_sales), 0) AS gross_sales, coalesce(sum(m.discounts), 0) AS discounts, coalesce(sum(m.refunds), 0) AS refunds,
  coalesce(sum(m.net_sales), 0) AS net_sales, coalesce(sum(m.quantity), 0) AS sold_units,
  coalesce(sum(m.returned_units), 0) AS returned_units, count(m.order_id) AS line_count
  FROM sold s LEFT JOIN measured m ON m.order_id = s.order_id GROUP BY ALL),
months AS (SELECT CAST(d AS DATE) AS month_start FROM generate_series(TIMESTAMP '{_START}', TIMESTAMP '{_BEFORE}' - INTERVAL 1 DAY, INTERVAL 1 MONTH) g(d))
"""

MONEY = ["gross_sales", "discounts", "sales_before_returns", "refunds", "net_sales"]
UNITS = ["sold_units", "returned_units"]


def sums_sql() -> str:
    """The seven additive measures."""
    money = [f"CAST(sum({m}) AS DECIMAL(28,6)) AS {m}" for m in MONEY]
    return ", ".join(money + [f"CAST(sum({u}) AS BIGINT) AS {u}" for u in UNITS])


def bundle_sql(by: str, source: str = "sales") -> str:
    """The bundle by brute force: plain sums and COUNT(DISTINCT)."""
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {keys}{sums_sql()}, count(DISTINCT order_id) AS completed_orders,"
        f" count(DISTINCT customer_id) AS purchasing_customers,"
        f" {quotient('sum(net_sales)', 'count(DISTINCT order_id)')} AS aov,"
        f" {quotient('sum(returned_units)', 'sum(sold_units)')} AS unit_return_rate FROM {source}{group}"
    )


def share_sql(by: str) -> str:
    return f"SELECT b.*, {quotient('b.net_sales', '(SELECT sum(net_sales) FROM sales)')} AS net_sales_share FROM ({bundle_sql(by)}) b"


def with_model(body: str, more: str = "") -> str:
    extra = f", {more}" if more else ""
    return f"WITH {MODEL_SQL}{extra} {body}"

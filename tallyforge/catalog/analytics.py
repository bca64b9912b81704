"""Facts, summaries, rankings, trends and scenarios over the clean model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import MEASURE
from ..plans import metrics as metric_plans
from ..plans import model as facts
from ..plans import reports
from ..sources.lake import model_tables
from .base import CONFIG, MONEY, UNITS, bundle_sql, query, quotient, rounded, settled_sql, share_sql, sums_sql, with_model

RATIOS = ["aov", "unit_return_rate"]


@query("line_sales", with_model(
    "SELECT order_line_id, order_id, customer_id, order_date, month_start, channel, product_id, product_name, category,"
    " CAST(sold_units AS BIGINT) AS sold_units, CAST(returned_units AS BIGINT) AS returned_units, unit_price, discount_rate,"
    " gross_sales, discounts, CAST(sales_before_returns AS DECIMAL(28,6)) AS sales_before_returns, refunds,"
    " CAST(net_sales AS DECIMAL(28,6)) AS net_sales FROM sales"))
def line_sales(spark, sf_dir):
    return facts.sales_lines(model_tables(spark, sf_dir), CONFIG)


@query("line_facts", with_model(
    "SELECT m.order_line_id, m.order_id, o.customer_id, c.customer_name, c.region, c.segment, c.email, o.order_date,"
    " strftime(o.order_date, '%Y-%m') AS order_month, o.channel, o.status, o.status = 'Completed' AS include_in_sales_kpi,"
    " m.product_id, p.product_name, p.category, p.list_price, m.quantity, m.unit_price, m.discount_rate,"
    " m.return_events, m.latest_return_date, m.gross_sales, m.discounts,"
    " CAST(m.sales_before_returns AS DECIMAL(28,6)) AS sales_before_returns, m.refunds,"
    " CAST(m.net_sales AS DECIMAL(28,6)) AS net_sales, CAST(m.quantity AS BIGINT) AS sold_units, m.returned_units"
    " FROM measured m JOIN m_orders o USING (order_id) JOIN m_customers c USING (customer_id) JOIN m_products p USING (product_id)"))
def line_facts(spark, sf_dir):
    return facts.line_facts(model_tables(spark, sf_dir), CONFIG, by_line=False)


@query("order_sales", with_model(
    "SELECT order_id, customer_id, order_date, month_start, channel, CAST(net_sales AS DECIMAL(28,6)) AS net_sales,"
    " CAST(sold_units AS BIGINT) AS sold_units, CAST(returned_units AS BIGINT) AS returned_units FROM order_sales"))
def order_sales(spark, sf_dir):
    frame = facts.order_sales(model_tables(spark, sf_dir), CONFIG, keep_empty=True)
    return frame.select("order_id", "customer_id", "order_date", "month_start", "channel", "net_sales", *UNITS)


@query("annual_kpis", with_model(
    f"SELECT 'USD' AS currency, '1995-01-01 through 2001-12-31' AS order_period, DATE '{CONFIG.return_cutoff}' AS return_cutoff,"
    f" s.*, o.completed_orders, {quotient('s.net_sales', 'o.completed_orders')} AS net_aov,"
    f" {quotient('s.returned_units', 's.sold_units')} AS unit_return_rate"
    f" FROM (SELECT {sums_sql()} FROM sales) s, (SELECT count(*) AS completed_orders FROM order_sales) o"))
def annual_kpis(spark, sf_dir):
    return rounded(reports.annual_kpis(model_tables(spark, sf_dir), CONFIG), "net_aov", "unit_return_rate")


@query("kpi_bundle", with_model(bundle_sql("")))
def kpi_bundle(spark, sf_dir):
    return rounded(reports.kpis(model_tables(spark, sf_dir), CONFIG), *RATIOS)


@query("excluded_counts", with_model(
    "SELECT (SELECT count(*) FROM m_orders WHERE status = 'Cancelled') AS cancelled_orders_excluded,"
    " (SELECT count(*) FROM m_lines WHERE order_id NOT IN (SELECT order_id FROM sold)) AS cancelled_lines_excluded"))
def excluded_counts(spark, sf_dir):
    return reports.excluded(model_tables(spark, sf_dir), CONFIG)


@query("order_summary", with_model(
    f"SELECT x.*, c.region, c.segment FROM ({share_sql('order_id, customer_id, order_date, month_start, channel')}) x"
    " JOIN m_customers c ON c.customer_id = x.customer_id"))
def order_summary(spark, sf_dir):
    return rounded(reports.order_summary(model_tables(spark, sf_dir), CONFIG), *RATIOS, "net_sales_share")


@query("category_summary", with_model(share_sql("category")))
def category_summary(spark, sf_dir):
    return rounded(reports.category_summary(model_tables(spark, sf_dir), CONFIG), *RATIOS, "net_sales_share")


@query("category_contribution", with_model(
    "SELECT category, net_sales, sold_units, returned_units, completed_orders AS completed_orders_with_category,"
    f" net_sales_share, unit_return_rate FROM ({share_sql('category')}) x"))
def category_contribution(spark, sf_dir):
    frame = reports.category_contribution(model_tables(spark, sf_dir), CONFIG)
    return rounded(frame, "net_sales_share", "unit_return_rate")


_RANKED = f"SELECT x.*, dense_rank() OVER (ORDER BY net_sales DESC) AS net_sales_rank FROM ({share_sql('product_id, product_name, category')}) x"


@query("product_summary_ranked", with_model(_RANKED))
def product_summary_ranked(spark, sf_dir):
    return rounded(reports.product_summary_ranked(model_tables(spark, sf_dir), CONFIG), *RATIOS, "net_sales_share")


@query("top_products", with_model(
    f"SELECT product_id, product_name, category, net_sales, CAST(net_sales_rank AS INT) AS net_sales_rank FROM ({_RANKED}) y WHERE net_sales_rank <= 5"))
def top_products(spark, sf_dir):
    frame = reports.top_products(model_tables(spark, sf_dir), CONFIG)
    return frame.select("product_id", "product_name", "category", "net_sales", "net_sales_rank")


@query("top3_products_per_category", with_model(
    "SELECT * FROM (SELECT category, product_id, product_name, net_sales, sold_units, returned_units,"
    " CAST(dense_rank() OVER (PARTITION BY category ORDER BY net_sales DESC) AS INT) AS category_rank"
    f" FROM ({bundle_sql('category, product_id, product_name')}) b) r WHERE category_rank <= 3"))
def top3_products_per_category(spark, sf_dir):
    return reports.top_products_per_category(model_tables(spark, sf_dir), CONFIG)


@query("top10_products_by_refund", with_model(
    "SELECT product_id, product_name, category, refunds, returned_units"
    f" FROM ({bundle_sql('category, product_id, product_name')}) b ORDER BY refunds DESC, product_id LIMIT 10"))
def top10_products_by_refund(spark, sf_dir):
    return reports.top_products_by_refund(model_tables(spark, sf_dir), CONFIG)


@query("channel_summary", with_model(share_sql("channel")))
def channel_summary(spark, sf_dir):
    return rounded(reports.channel_summary(model_tables(spark, sf_dir), CONFIG), *RATIOS, "net_sales_share")


@query("channel_rates", with_model(
    "SELECT channel, count(*) AS completed_orders, CAST(sum(net_sales) AS DECIMAL(28,6)) AS net_sales,"
    " CAST(sum(sold_units) AS BIGINT) AS sold_units, CAST(sum(returned_units) AS BIGINT) AS returned_units,"
    f" {quotient('sum(net_sales)', 'count(*)')} AS net_aov, {quotient('sum(returned_units)', 'sum(sold_units)')} AS unit_return_rate"
    " FROM order_sales GROUP BY channel"))
def channel_rates(spark, sf_dir):
    """Channel ratios over order headers, orders without lines included."""
    frame = reports.channel_summary(model_tables(spark, sf_dir), CONFIG, keep_empty=True)
    return rounded(
        frame.select("channel", "completed_orders", "net_sales", *UNITS, F.col("aov").alias("net_aov"), "unit_return_rate"),
        "net_aov", "unit_return_rate",
    )


@query("region_summary", with_model(share_sql("region")))
def region_summary(spark, sf_dir):
    return rounded(reports.region_summary(model_tables(spark, sf_dir), CONFIG), *RATIOS, "net_sales_share")


_ZERO = ", ".join(
    [f"coalesce(x.{m}, 0) AS {m}" for m in MONEY]
    + [f"coalesce(x.{c}, 0) AS {c}" for c in [*UNITS, "completed_orders", "purchasing_customers"]]
)


@query("customer_summary", with_model(
    f"SELECT c.customer_id, c.customer_name, c.region, c.segment, {_ZERO}, x.aov, x.unit_return_rate,"
    " coalesce(x.net_sales_share, 0) AS net_sales_share, coalesce(x.completed_orders, 0) >= 2 AS is_repeat_customer"
    f" FROM m_customers c LEFT JOIN ({share_sql('customer_id')}) x ON x.customer_id = c.customer_id"))
def customer_summary(spark, sf_dir):
    return rounded(reports.customer_summary(model_tables(spark, sf_dir), CONFIG), *RATIOS, "net_sales_share")


@query("repeat_customers", with_model(
    "SELECT count(*) AS purchasing_customers, count(*) FILTER (n >= 2) AS repeat_customers,"
    f" {quotient('count(*) FILTER (n >= 2)', 'count(*)')} AS repeat_customer_rate,"
    " CAST(coalesce(sum(net) FILTER (n >= 2), 0) AS DECIMAL(28,6)) AS repeat_customer_net_sales,"
    f" {quotient('coalesce(sum(net) FILTER (n >= 2), 0)', 'sum(net)')} AS repeat_customer_sales_share"
    " FROM (SELECT customer_id, count(*) AS n, sum(net_sales) AS net FROM order_sales GROUP BY customer_id) t"))
def repeat_customers(spark, sf_dir):
    frame = reports.repeat_customers(model_tables(spark, sf_dir), CONFIG)
    return rounded(frame, "repeat_customer_rate", "repeat_customer_sales_share")


_MONTH_ZERO = ", ".join(
    [f"CAST(coalesce(b.{m}, 0) AS DECIMAL(28,6)) AS {m}" for m in MONEY]
    + [f"coalesce(b.{c}, 0) AS {c}" for c in [*UNITS, "completed_orders", "purchasing_customers"]]
)
_MONTHLY = (
    f"filled AS (SELECT m.month_start, strftime(m.month_start, '%Y-%m') AS order_month, {_MONTH_ZERO}, b.aov, b.unit_return_rate,"
    f" coalesce(b.net_sales_share, 0) AS net_sales_share FROM months m LEFT JOIN ({share_sql('month_start')}) b ON b.month_start = m.month_start),"
    " lagged AS (SELECT *, lag(net_sales) OVER (ORDER BY month_start) AS previous_net_sales,"
    " sum(net_sales) OVER (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sum3,"
    " count(*) OVER (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n3 FROM filled)"
)
_GROWTH = quotient("net_sales - previous_net_sales", "previous_net_sales")
_MEAN3 = "CASE WHEN n3 = 3 THEN " + settled_sql("CAST(sum3 AS DOUBLE) / 3", 4) + " END"


def _money_mean(frame):
    return rounded(frame, "trailing_3_month_avg", digits=4)


@query("monthly_summary", with_model(
    f"SELECT * EXCLUDE (sum3, n3), {_GROWTH} AS mom_growth, {_MEAN3} AS trailing_3_month_avg FROM lagged", _MONTHLY))
def monthly_summary(spark, sf_dir):
    frame = reports.monthly(model_tables(spark, sf_dir), CONFIG)
    return _money_mean(rounded(frame, *RATIOS, "net_sales_share", "mom_growth"))


@query("monthly_trend_zero_default", with_model(
    "SELECT * EXCLUDE (sum3, n3, aov, unit_return_rate), coalesce(aov, 0) AS aov, coalesce(unit_return_rate, 0) AS unit_return_rate,"
    f" coalesce({_GROWTH}, 0) AS mom_growth, {_MEAN3} AS trailing_3_month_avg FROM lagged", _MONTHLY))
def monthly_trend_zero_default(spark, sf_dir):
    """The dashboard variant: undefined ratios read as zero."""
    frame = reports.monthly(model_tables(spark, sf_dir), CONFIG, zero_default=True)
    return _money_mean(rounded(frame, *RATIOS, "net_sales_share", "mom_growth"))


_TREND = (
    "monthly AS (SELECT month_start, count(*) AS n, sum(net_sales) AS net FROM order_sales GROUP BY month_start),"
    " filled AS (SELECT m.month_start, coalesce(n, 0) AS completed_orders, CAST(coalesce(net, 0) AS DECIMAL(28,6)) AS net_sales"
    " FROM months m LEFT JOIN monthly t ON t.month_start = m.month_start),"
    " prior AS (SELECT *, lag(net_sales) OVER w AS p_net, lag(completed_orders) OVER w AS p_orders,"
    " CAST(sum(net_sales) OVER (ORDER BY month_start ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,6)) AS running_net_sales,"
    " sum(net_sales) OVER (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sum3,"
    " count(*) OVER (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n3 FROM filled WINDOW w AS (ORDER BY month_start))"
)


@query("monthly_trend", with_model(
    f"SELECT month_start, completed_orders, net_sales, {quotient('net_sales', 'completed_orders')} AS net_aov,"
    f" {quotient('net_sales - p_net', 'p_net')} AS mom_net_sales_growth, {quotient('completed_orders - p_orders', 'p_orders')} AS mom_order_growth,"
    f" running_net_sales, {_MEAN3} AS moving_average_3_months FROM prior", _TREND))
def monthly_trend(spark, sf_dir):
    frame = rounded(
        reports.monthly_trend(model_tables(spark, sf_dir), CONFIG), "net_aov", "mom_net_sales_growth", "mom_order_growth"
    )
    return rounded(frame, "moving_average_3_months", digits=4)


@query("returning_at_purchase", with_model(
    "SELECT m.month_start, CAST(coalesce(net, 0) AS DECIMAL(28,6)) AS net_sales,"
    " CAST(coalesce(later, 0) AS DECIMAL(28,6)) AS returning_at_purchase_net_sales,"
    f" {quotient('later', 'net')} AS returning_at_purchase_share FROM months m LEFT JOIN"
    " (SELECT o.month_start, sum(o.net_sales) AS net, sum(CASE WHEN o.order_date > f.d THEN o.net_sales ELSE 0 END) AS later"
    " FROM order_sales o JOIN (SELECT customer_id, min(order_date) AS d FROM order_sales GROUP BY customer_id) f"
    " ON f.customer_id = o.customer_id GROUP BY o.month_start) t ON t.month_start = m.month_start"))
def returning_at_purchase(spark, sf_dir):
    return rounded(reports.returning_at_purchase(model_tables(spark, sf_dir), CONFIG), "returning_at_purchase_share")


@query("order_sequence", with_model(
    "SELECT customer_id, order_id, order_date, CAST(net_sales AS DECIMAL(28,6)) AS net_sales,"
    " row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS observed_order_sequence FROM order_sales"))
def order_sequence(spark, sf_dir):
    return reports.order_sequence(model_tables(spark, sf_dir), CONFIG)


_NET4 = settled_sql("CAST(net_sales AS DOUBLE)", 4)
_RATE4 = settled_sql("coalesce(CAST(returned_units AS DOUBLE) / sold_units, 0)", 4)


@query("findings_extremes", with_model(
    f"SELECT * FROM (SELECT 'peak_month' AS finding, order_month AS member, {_NET4} AS value FROM filled ORDER BY net_sales DESC, order_month LIMIT 1)"
    f" UNION ALL SELECT * FROM (SELECT 'lowest_month', order_month, {_NET4} FROM filled ORDER BY net_sales, order_month LIMIT 1)"
    f" UNION ALL SELECT * FROM (SELECT 'top_category', category, {_NET4} FROM c ORDER BY net_sales DESC, category LIMIT 1)"
    f" UNION ALL SELECT * FROM (SELECT 'highest_return_rate_category', category, {_RATE4} FROM c"
    " ORDER BY coalesce(CAST(returned_units AS DOUBLE) / sold_units, 0) DESC, category LIMIT 1)"
    f" UNION ALL SELECT * FROM (SELECT 'top_channel', channel, {_NET4} FROM ch ORDER BY net_sales DESC, channel LIMIT 1)"
    f" UNION ALL SELECT * FROM (SELECT 'top_region', region, {_NET4} FROM r ORDER BY net_sales DESC, region LIMIT 1)",
    f"{_MONTHLY}, c AS ({bundle_sql('category')}), ch AS ({bundle_sql('channel')}), r AS ({bundle_sql('region')})"))
def findings_extremes(spark, sf_dir):
    frame = reports.findings(model_tables(spark, sf_dir), CONFIG)
    return rounded(frame, "value", digits=4)


@query("refund_by_reason", with_model(
    "SELECT reason, refunds, returned_units, return_events,"
    f" {quotient('refunds', '(SELECT sum(refunds) FROM e)')} AS refund_share,"
    f" {quotient('return_events', '(SELECT sum(return_events) FROM e)')} AS event_share FROM e",
    "e AS (SELECT r.reason, CAST(sum(r.return_quantity * l.unit_price * (1 - l.discount_rate)) AS DECIMAL(28,6)) AS refunds,"
    " CAST(sum(r.return_quantity) AS BIGINT) AS returned_units, count(*) AS return_events"
    " FROM m_returns r JOIN m_lines l ON l.order_line_id = r.order_line_id JOIN sold s ON s.order_id = l.order_id"
    f" WHERE r.return_date <= DATE '{CONFIG.return_cutoff}' GROUP BY r.reason)"))
def refund_by_reason(spark, sf_dir):
    return rounded(reports.refund_by_reason(model_tables(spark, sf_dir), CONFIG), "refund_share", "event_share")


@query("refund_trend", with_model(
    "SELECT month_start, refunds, returned_units, sold_units, unit_return_rate FROM filled", _MONTHLY))
def refund_trend(spark, sf_dir):
    return rounded(reports.refund_trend(model_tables(spark, sf_dir), CONFIG), "unit_return_rate")


@query("return_rate_by_category", with_model(
    f"SELECT category, CAST(sum(sold_units) AS BIGINT) AS sold_units, CAST(sum(returned_units) AS BIGINT) AS returned_units,"
    f" coalesce({quotient('sum(returned_units)', 'sum(sold_units)')}, 0) AS unit_return_rate FROM sales GROUP BY category"))
def return_rate_by_category(spark, sf_dir):
    return rounded(reports.return_rate_by_category(model_tables(spark, sf_dir), CONFIG), "unit_return_rate")


@query("period_decomposition", with_model(
    "SELECT month_start, completed_orders, " + settled_sql("a", 4) + " AS net_aov, completed_orders - p_orders AS orders_change,"
    " " + settled_sql("a - lag(a) OVER (ORDER BY month_start)", 4) + " AS aov_change,"
    f" {quotient('completed_orders - p_orders', 'p_orders')} AS orders_change_rate,"
    " " + settled_sql("(a - lag(a) OVER (ORDER BY month_start)) / lag(a) OVER (ORDER BY month_start)") + " AS aov_change_rate,"
    f" {quotient('net_sales - p_net', 'p_net')} AS net_change_rate"
    " FROM (SELECT *, CAST(net_sales AS DOUBLE) / nullif(completed_orders, 0) AS a FROM prior) x", _TREND))
def period_decomposition(spark, sf_dir):
    frame = rounded(
        reports.period_decomposition(model_tables(spark, sf_dir), CONFIG),
        "orders_change_rate", "aov_change_rate", "net_change_rate",
    )
    return rounded(frame, "net_aov", "aov_change", digits=4)


_WHOLE = "(SELECT CAST(sum(net_sales) AS DOUBLE) / count(DISTINCT order_id) FROM sales)"
_WHOLE_RATE = "(SELECT CAST(sum(returned_units) AS DOUBLE) / sum(sold_units) FROM sales)"


def _gap_sql(dimension: str) -> str:
    aov = "CAST(sum(net_sales) AS DOUBLE) / count(DISTINCT order_id)"
    rate = "CAST(sum(returned_units) AS DOUBLE) / sum(sold_units)"
    return (
        f"SELECT '{dimension}' AS dimension, {dimension} AS member, count(DISTINCT order_id) AS completed_orders,"
        f" {settled_sql(aov, 4)} AS aov, {settled_sql(rate)} AS unit_return_rate,"
        f" {settled_sql(f'{aov} - {_WHOLE}', 4)} AS aov_gap,"
        f" {settled_sql(f'({rate} - {_WHOLE_RATE}) * 100')} AS return_rate_gap_points"
        f" FROM sales GROUP BY {dimension}"
    )


@query("group_vs_overall", with_model(f"{_gap_sql('channel')} UNION ALL {_gap_sql('region')}"))
def group_vs_overall(spark, sf_dir):
    frame = reports.group_vs_overall(model_tables(spark, sf_dir), CONFIG)
    frame = rounded(frame, "unit_return_rate", "return_rate_gap_points")
    return rounded(frame, "aov", "aov_gap", digits=4)


@query("region_order_pivot", with_model(
    "SELECT c.region, count(DISTINCT o.order_id) FILTER (o.status = 'Completed') AS completed_orders,"
    " count(DISTINCT o.order_id) FILTER (o.status = 'Cancelled') AS cancelled_orders"
    " FROM m_orders o JOIN m_customers c ON c.customer_id = o.customer_id GROUP BY c.region"))
def region_order_pivot(spark, sf_dir):
    return reports.region_order_pivot(model_tables(spark, sf_dir), CONFIG)


@query("calendar", with_model(
    "SELECT CAST(d AS DATE) AS calendar_date, CAST(year(d) AS INT) AS calendar_year, CAST(month(d) AS INT) AS month_number,"
    " strftime(d, '%b') AS month_name, CAST(date_trunc('month', d) AS DATE) AS month_start, coalesce(n, 0) AS orders"
    f" FROM generate_series(TIMESTAMP '{CONFIG.order_from}', TIMESTAMP '{CONFIG.order_before}' - INTERVAL 1 DAY, INTERVAL 1 DAY) g(d)"
    " LEFT JOIN (SELECT order_date, count(*) AS n FROM m_orders GROUP BY order_date) o ON o.order_date = CAST(d AS DATE)"))
def calendar(spark, sf_dir):
    """Every day of the window with its attributes and the orders placed on it."""
    orders = model_tables(spark, sf_dir)["orders"].groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))
    days = facts.calendar(spark, CONFIG)
    return days.join(orders, days["calendar_date"] == orders["order_date"], "left").drop("order_date").fillna(0, subset=["orders"])


_SCENARIO_SQL = (
    "base AS (SELECT l.*, coalesce(r.returned_units, 0) AS back FROM m_lines l LEFT JOIN returned r ON r.order_line_id = l.order_line_id"
    " WHERE l.order_id IN (SELECT order_id FROM sold)),"
    " changed AS (SELECT quantity, discount_rate, back, CASE WHEN quantity = 1 THEN CAST(unit_price + 10 AS DECIMAL(12,2)) ELSE unit_price END AS unit_price FROM base),"
    " totals AS (SELECT 0 AS after, quantity, unit_price, discount_rate, back FROM base UNION ALL SELECT 1, quantity, unit_price, discount_rate, back FROM changed),"
    " lines AS (SELECT after, quantity AS sold_units, back AS returned_units, quantity * unit_price AS gross_sales,"
    " quantity * unit_price * discount_rate AS discounts, back * unit_price * (1 - discount_rate) AS refunds FROM totals),"
    " wide AS (SELECT after, sum(gross_sales) AS gross_sales, sum(discounts) AS discounts, sum(gross_sales) - sum(discounts) AS sales_before_returns,"
    " sum(refunds) AS refunds, sum(gross_sales) - sum(discounts) - sum(refunds) AS net_sales, sum(sold_units) AS sold_units,"
    " sum(returned_units) AS returned_units FROM lines GROUP BY after)"
)
_SCENARIO_BODY = " UNION ALL ".join(
    f"SELECT '{m}' AS measure, CAST(max(CASE WHEN after = 0 THEN {m} END) AS DECIMAL(28,6)) AS base,"
    f" CAST(max(CASE WHEN after = 1 THEN {m} END) AS DECIMAL(28,6)) AS scenario,"
    f" CAST(max(CASE WHEN after = 1 THEN {m} END) - max(CASE WHEN after = 0 THEN {m} END) AS DECIMAL(28,6)) AS change FROM wide"
    for m in [*MONEY, *UNITS]
)


@query("what_if", with_model(_SCENARIO_BODY, _SCENARIO_SQL))
def what_if(spark, sf_dir):
    """Ten more per unit on every line that sold one unit."""
    model = model_tables(spark, sf_dir)
    single = model["order_lines"].filter("quantity = 1")
    overrides = single.select("order_line_id", (F.col("unit_price") + 10).alias("unit_price"))
    return reports.what_if(model, CONFIG, overrides)


@query("metrics_by_context", with_model(
    bundle_sql("category, month_start", "(SELECT * FROM sales WHERE channel = 'Online') x")))
def metrics_by_context(spark, sf_dir):
    """The bundle for one channel, drilled down to category and month."""
    lines = facts.sales_lines(model_tables(spark, sf_dir), CONFIG)
    frame = metric_plans.filtered_metrics(lines, F.col("channel") == "Online", ["category", "month_start"])
    return rounded(frame, *RATIOS)


@query("named_measures", with_model(
    f"SELECT month_start, net_sales AS net_sales_after_refunds, coalesce(unit_return_rate, 0) AS return_rate,"
    f" previous_net_sales AS previous_month_net_sales, coalesce({_GROWTH}, 0) AS monthly_growth FROM lagged", _MONTHLY))
def named_measures(spark, sf_dir):
    """The dashboard measures by month, undefined divisions read as zero."""
    frame = reports.monthly(model_tables(spark, sf_dir), CONFIG, zero_default=True).select(
        "month_start",
        F.col("net_sales").cast(MEASURE).alias("net_sales_after_refunds"),
        F.col("unit_return_rate").alias("return_rate"),
        F.col("previous_net_sales").alias("previous_month_net_sales"),
        F.col("mom_growth").alias("monthly_growth"),
    )
    return rounded(frame, "return_rate", "monthly_growth")

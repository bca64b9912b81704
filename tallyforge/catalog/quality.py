"""Scalar readers, checks, comparisons, sources and sinks over the lake."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CANONICAL
from ..functions import dates, numbers, text
from ..functions import sql as sql_functions
from ..functions.numbers import MEASURE
from ..operators import audit, compare
from ..operators.clean import accepted
from ..plans import checks, reports
from ..plans import model as facts
from ..session import settler, shared_dir
from ..sources import csv, files
from ..sources.lake import model_tables, padded
from . import cleaning_sql as plain
from .base import CONFIG, MONEY, UNITS, bundle_sql, query, with_model
from .cleaning import _labelled, _sources

DIRTY = plain.CONFIG


def _raw_sql(name: str, columns: str) -> str:
    return f"SELECT CAST(source_row AS VARCHAR) AS source_row, {columns} FROM ({plain.RAW_SQL[name]}) raw"


def _raw(spark, sf_dir, name: str) -> DataFrame:
    return _sources(spark, sf_dir)[name].withColumn("source_row", F.col("source_row").cast("string"))


# ------------------------------------------------------------------ scalar readers


@query("parse_dates", _raw_sql("orders", f"order_date AS cell, {plain.day(plain.strip('order_date'))} AS parsed"))
def parse_dates(spark, sf_dir):
    cell = F.col("order_date")
    return _raw(spark, sf_dir, "orders").select("source_row", cell.alias("cell"), dates.explicit_date(text.strip(cell)).alias("parsed"))


def _cast10(expression: str, name: str) -> str:
    return f"CAST({expression} AS DECIMAL(28,10)) AS {name}"


@query("parse_numbers", _raw_sql("order_lines", ", ".join([
    _cast10(plain.number(plain.strip("quantity")), "quantity"),
    _cast10(plain.currency(plain.strip("unit_price")), "unit_price"),
    _cast10(plain.percent(plain.strip("discount_rate")), "discount_rate"),
    f"{plain.whole(plain.number(plain.strip('quantity')))} AS units"])))
def parse_numbers(spark, sf_dir):
    def cell(name):
        return text.strip(F.col(name))

    return _raw(spark, sf_dir, "order_lines").select(
        "source_row",
        numbers.us_number(cell("quantity")).cast("decimal(28,10)").alias("quantity"),
        numbers.currency(cell("unit_price")).cast("decimal(28,10)").alias("unit_price"),
        numbers.percent(cell("discount_rate")).cast("decimal(28,10)").alias("discount_rate"),
        numbers.whole_count(numbers.us_number(cell("quantity"))).alias("units"),
    )


@query("parse_numbers_lenient", _raw_sql("products", "list_price AS cell, " + _cast10(
    plain.loose_number("trim(replace(" + plain.strip("list_price") + ", '$', ''))"), "parsed")))
def parse_numbers_lenient(spark, sf_dir):
    bare = text.strip(F.replace(text.strip(F.col("list_price")), F.lit("$"), F.lit("")))
    return _raw(spark, sf_dir, "products").select(
        "source_row", F.col("list_price").alias("cell"), numbers.us_number_lenient(bare).cast("decimal(28,10)").alias("parsed")
    )


@query("title_case", _raw_sql("products", f"category AS cell, {plain.title('category')} AS titled,"
       " upper(category[1]) || lower(category[2:]) AS first_upper"))
def title_case(spark, sf_dir):
    cell = F.col("category")
    return _raw(spark, sf_dir, "products").select(
        "source_row", cell.alias("cell"), text.title_case(cell).alias("titled"), text.first_upper(cell).alias("first_upper")
    )


@query("text_pieces", _raw_sql("products", "left(list_price, 1) AS first_char, right(list_price, 2) AS last_two,"
       " substr(product_name, 2, 3) AS middle, CAST(length(rtrim(product_name)) AS INT) AS length_without_blanks,"
       " replace(list_price, '$', '') AS without_sign, regexp_matches(list_price, '^[0-9]') AS starts_with_digit,"
       " nullif(trim(product_name), '') AS cleaned"))
def text_pieces(spark, sf_dir):
    price, name = F.col("list_price"), F.col("product_name")
    return _raw(spark, sf_dir, "products").select(
        "source_row",
        F.left(price, F.lit(1)).alias("first_char"),
        F.right(price, F.lit(2)).alias("last_two"),
        F.substring(name, 2, 3).alias("middle"),
        F.length(F.rtrim(name)).alias("length_without_blanks"),
        F.replace(price, F.lit("$"), F.lit("")).alias("without_sign"),
        price.rlike("^[0-9]").alias("starts_with_digit"),
        text.clean_text(name).alias("cleaned"),
    )


@query("row_json", "SELECT source_row, doc AS raw_json, doc ->> '$.region' AS region, TRUE AS valid FROM (SELECT CAST(source_row AS VARCHAR) AS source_row,"
       " CAST(to_json({'customer_id': customer_id, 'customer_name': customer_name, 'region': region, 'segment': segment, 'email': nullif(email, '')}) AS VARCHAR) AS doc"
       f" FROM ({plain.RAW_SQL['customers']}) raw) j")
def row_json(spark, sf_dir):
    """Rows as JSON with NULLs kept, one member read back, and validity."""
    rows = _raw(spark, sf_dir, "customers").withColumn("email", F.nullif("email", F.lit("")))
    document = text.row_json(DIRTY.table("customers").columns)
    return rows.select("source_row", document.alias("raw_json")).select(
        "*", text.json_field(F.col("raw_json"), "region").alias("region"), text.is_json(F.col("raw_json")).alias("valid")
    )


@query("sql_functions", _raw_sql("orders", f"nullif({plain.strip('status')}, '') AS status, {plain.day(plain.strip('order_date'))} AS order_date,"
       f" CAST({plain.number(plain.strip('substr(order_id, 2)'))} AS DECIMAL(28,10)) AS order_number"))
def sql_functions_query(spark, sf_dir):
    """The scalar readers called from SQL text."""
    sql_functions.register(spark)
    return _raw(spark, sf_dir, "orders").selectExpr(
        "source_row", "clean_text(status) AS status", "explicit_date(order_date) AS order_date", "us_number(substr(order_id, 2)) AS order_number"
    )


@query("date_parts", with_model(
    "SELECT order_id, CAST(year(order_date) AS INT) AS y, CAST(month(order_date) AS INT) AS m, strftime(order_date, '%Y-%m') AS month_key,"
    " CAST(date_trunc('month', order_date) AS DATE) AS month_start, CAST(order_date + INTERVAL 1 DAY AS DATE) AS next_day,"
    " make_date(year(order_date), month(order_date), 1) AS rebuilt FROM m_orders"))
def date_parts(spark, sf_dir):
    day = F.col("order_date")
    return model_tables(spark, sf_dir)["orders"].select(
        "order_id", F.year(day).alias("y"), F.month(day).alias("m"), dates.month_key(day).alias("month_key"),
        dates.month_start(day).alias("month_start"), F.date_add(day, 1).alias("next_day"),
        F.make_date(F.year(day), F.month(day), F.lit(1)).alias("rebuilt"),
    )


# ------------------------------------------------------------------ checks


def _model_check(name: str, sql: str, *, stored: bool = False):
    """Register a check over the model; ``stored`` facts serve checks that read them many times."""

    def register(build):
        @query(name, with_model(sql))
        def run(spark, sf_dir):
            model = model_tables(spark, sf_dir)
            return build(facts.prepared(model, CONFIG, settler(spark), line_ids=False) if stored else model)

        return build

    return register


def _check_sql(name: str, passed: str, detail: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", {passed} AS passed, {detail} AS detail FROM {source}"


_UNIQUE = " UNION ALL ".join(
    _check_sql(f"unique_{t.name}_keys", f"count(*) = count(DISTINCT {t.key})", "count(*) || ' clean rows'", f"m_{'lines' if t.name == 'order_lines' else t.name}")
    for t in CONFIG.tables
)


@_model_check("unique_keys", _UNIQUE)
def unique_keys(model):
    return checks.unique_keys(model, CONFIG)


_FANOUT = _check_sql(
    "no_fact_join_fanout", "facts = lines", "facts || ' joined facts / ' || lines || ' clean lines'",
    "(SELECT (SELECT count(*) FROM measured m JOIN m_orders o USING (order_id) JOIN m_customers USING (customer_id) JOIN m_products USING (product_id)) AS facts,"
    " (SELECT count(*) FROM m_lines) AS lines) t",
)


@_model_check("join_fanout_check", _FANOUT)
def join_fanout_check(model):
    return checks.join_fanout(model, CONFIG)


_GRAIN = _check_sql(
    "one_row_per_completed_order", "n = d AND n = s", "n || ' rows / ' || s || ' orders'",
    "(SELECT count(*) AS n, count(DISTINCT order_id) AS d, (SELECT count(*) FROM sold) AS s FROM order_sales) t",
)


@_model_check("order_grain_check", _GRAIN)
def order_grain_check(model):
    return checks.order_grain(model, CONFIG)


_HAVE_LINES = _check_sql(
    "completed_orders_have_lines", "n = 0", "n || ' orders without lines'", "(SELECT count(*) AS n FROM order_sales WHERE line_count = 0) t"
)


@_model_check("completed_orders_have_lines", _HAVE_LINES)
def completed_orders_have_lines(model):
    return checks.completed_orders_have_lines(model, CONFIG)


_ORPHANS = " UNION ALL ".join(
    f"SELECT '{child}' AS child, '{parent}' AS parent, count(*) AS orphans FROM m_{c} WHERE {col} NOT IN (SELECT {col} FROM m_{p})"
    for child, parent, c, p, col in [
        ("orders", "customers", "orders", "customers", "customer_id"),
        ("order_lines", "orders", "lines", "orders", "order_id"),
        ("order_lines", "products", "lines", "products", "product_id"),
        ("returns", "order_lines", "returns", "lines", "order_line_id"),
    ]
)


@_model_check("orphans", _ORPHANS)
def orphans(model):
    return checks.orphans(model, CONFIG)


_FOREIGN = _check_sql("all_foreign_keys_valid", "sum(orphans) = 0", "CAST(sum(orphans) AS BIGINT) || ' orphans'", f"({_ORPHANS}) o")


@_model_check("foreign_keys_check", _FOREIGN)
def foreign_keys_check(model):
    return checks.foreign_keys(model, CONFIG)


_BOUNDED = _check_sql(
    "cumulative_return_quantity_bounded", "n = 0", "n || ' lines out of bounds'",
    "(SELECT count(*) FILTER (returned_units < 0 OR returned_units > quantity) AS n FROM measured) t",
)


@_model_check("returns_bounded", _BOUNDED)
def returns_bounded(model):
    return checks.returns_bounded(model, CONFIG)


_RECONCILE_RETURNS = _check_sql(
    "return_quantities_reconcile", "e = s", "e || ' units in events / ' || s || ' in sales'",
    "(SELECT CAST((SELECT sum(return_quantity) FROM m_returns) AS BIGINT) AS e, CAST((SELECT sum(returned_units) FROM sales) AS BIGINT) AS s) t",
)


@_model_check("returns_reconcile", _RECONCILE_RETURNS)
def returns_reconcile(model):
    return checks.returns_reconcile(model, CONFIG)


_IDENTITY = _check_sql(
    "line_sales_identity", "n = 0", "n || ' lines differ'",
    "(SELECT count(*) FILTER (gross_sales - discounts - refunds <> net_sales OR"
    " CAST((sold_units - returned_units) * unit_price * (1 - discount_rate) AS DECIMAL(28,6)) <> net_sales) AS n FROM sales) t",
)


@_model_check("line_identity", _IDENTITY)
def line_identity(model):
    return checks.line_identity(model, CONFIG)


_DAYS = (CONFIG.order_before - CONFIG.order_from).days


def _reconcile_sql(name: str, by: str, source: str = "sales") -> str:
    gaps = ", ".join(f"abs(sum(b.{m}) - any_value(t.{m}))" for m in [*MONEY, *UNITS])
    gap = f"CAST(greatest({gaps}) AS DECIMAL(38,6))"
    total = ", ".join(f"sum({m}) AS {m}" for m in [*MONEY, *UNITS])
    return _check_sql(
        f"reconcile_{name}", f"{gap} = 0", f"'largest gap ' || {gap}", f"({bundle_sql(by)}) b, (SELECT {total} FROM sales) t"
    )


_RECONCILE = " UNION ALL ".join(
    _reconcile_sql(name, by)
    for name, by in [
        ("order_summary", "order_id"), ("monthly_summary", "month_start"), ("category_summary", "category"),
        ("product_summary", "product_id"), ("channel_summary", "channel"), ("region_summary", "region"), ("customer_summary", "customer_id"),
    ]
)


@_model_check("reconcile_summaries", _RECONCILE, stored=True)
def reconcile_summaries(model):
    return checks.reconcile_summaries(model, CONFIG)


_TOTALS = _check_sql(
    "monthly_order_line_totals", "abs(o - l) <= 0.000001", "'net ' || l",
    "(SELECT CAST((SELECT sum(net_sales) FROM sales) AS DECIMAL(28,6)) AS l, CAST((SELECT sum(net_sales) FROM order_sales) AS DECIMAL(28,6)) AS o) t",
)


@_model_check("totals_reconcile", _TOTALS)
def totals_reconcile(model):
    return checks.totals_reconcile(model, CONFIG)


_CALENDAR = _check_sql(
    "calendar_complete", "TRUE", f"'{_DAYS} days, ' || n || ' months'", "(SELECT count(*) AS n FROM months) t"
)


@_model_check("validation_checks", " UNION ALL ".join(
    f"({part})" for part in [_UNIQUE, _FANOUT, _GRAIN, _HAVE_LINES, _FOREIGN, _BOUNDED, _RECONCILE_RETURNS, _IDENTITY, _CALENDAR, _RECONCILE, _TOTALS]), stored=True)
def validation_checks(model):
    """Every check of a run in one frame."""
    return checks.all_checks(model, CONFIG)


@_model_check("status_counts", "SELECT status, count(*) AS orders FROM m_orders GROUP BY status")
def status_counts(model):
    return checks.status_counts(model, CONFIG)


_EVENTS = (
    "(SELECT r.*, l.quantity, o.status, o.order_date FROM m_returns r LEFT JOIN m_lines l USING (order_line_id) LEFT JOIN m_orders o USING (order_id)) e"
)


@_model_check("return_parent_rules", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER ({condition}) AS violations FROM {_EVENTS}"
    for rule, condition in [
        ("unknown_line", "quantity IS NULL"),
        ("order_not_completed", "status <> 'Completed'"),
        ("before_order_date", "return_date < order_date"),
        ("after_cutoff", f"return_date > DATE '{CONFIG.return_cutoff}'"),
    ]) + " UNION ALL SELECT 'units_over_quantity', count(*) FROM (SELECT l.order_line_id FROM m_returns r JOIN m_lines l USING (order_line_id)"
    " GROUP BY l.order_line_id, l.quantity HAVING sum(r.return_quantity) > l.quantity) x")
def return_parent_rules(model):
    return checks.return_parent_rules(model, CONFIG)


def _constraint_sql() -> str:
    parts = []
    for t in CONFIG.tables:
        source = f"m_{'lines' if t.name == 'order_lines' else t.name}"
        rules = []
        for f in t.fields:
            if f.kind != "email":
                rules.append((f"{f.name} not null", f"{f.name} IS NULL"))
            if f.domain:
                words = ", ".join(f"'{w}'" for w in f.domain)
                rules.append((f"{f.name} in domain", f"{f.name} NOT IN ({words})"))
            if f.kind in ("price", "count"):
                rules.append((f"{f.name} positive", f"{f.name} <= 0"))
            if f.kind == "rate":
                rules.append((f"{f.name} in [0,1]", f"{f.name} NOT BETWEEN 0 AND 1"))
        if t.name == "orders":
            rules.append(("order_date in window", f"NOT (order_date >= DATE '{CONFIG.order_from}' AND order_date < DATE '{CONFIG.order_before}')"))
        if t.name == "returns":
            rules.append(("return_date up to cutoff", f"return_date > DATE '{CONFIG.return_cutoff}'"))
        for rule, condition in rules:
            parts.append(f"SELECT '{t.name}' AS \"table\", '{rule}' AS rule, count(*) FILTER ({condition}) AS violations FROM {source}")
        parts.append(
            f"SELECT '{t.name}', '{t.key} unique', count(*) FROM (SELECT {t.key} FROM {source} GROUP BY {t.key} HAVING count(*) > 1) u"
        )
    return " UNION ALL ".join(parts)


@_model_check("constraint_violations", _constraint_sql())
def constraint_violations(model):
    return checks.constraint_violations(model, CONFIG)


# ------------------------------------------------------------------ comparisons


@query("expected_vs_actual", with_model(
    "SELECT measure, expected, actual, CAST(expected AS DECIMAL(38,10)) = CAST(actual AS DECIMAL(38,10)) AS passed FROM ("
    "SELECT 'completed_orders' AS measure, CAST((SELECT count(*) FROM sold) AS VARCHAR) AS expected, CAST((SELECT count(DISTINCT order_id) FROM sales) AS VARCHAR) AS actual"
    " UNION ALL SELECT 'sold_units', CAST((SELECT CAST(sum(sold_units) AS BIGINT) FROM order_sales) AS VARCHAR), CAST((SELECT CAST(sum(sold_units) AS BIGINT) FROM sales) AS VARCHAR)"
    " UNION ALL SELECT 'net_sales', CAST((SELECT CAST(sum(net_sales) AS DECIMAL(28,6)) FROM order_sales) AS VARCHAR), CAST((SELECT CAST(sum(net_sales) AS DECIMAL(28,6)) FROM sales) AS VARCHAR)) t"))
def expected_vs_actual(spark, sf_dir):
    """Header-based expectations against line-based totals: orders without lines make a difference."""
    model = model_tables(spark, sf_dir)
    names = ["completed_orders", "sold_units", "net_sales"]
    headers = reports.annual_kpis(model, CONFIG)
    cells = [F.struct(F.lit(n).alias("measure"), F.col(n).cast("string").alias("expected")) for n in names]
    expected = headers.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    actual = checks.actual_measures(model, CONFIG).filter(F.col("measure").isin(names))
    return compare.expected_vs_actual(expected, actual)


_DIFF_COLUMNS = ["customer_name", "region", "segment", "email"]
_DIFF_RIGHT = (
    "SELECT 'C' || CASE WHEN c_custkey < 1000000000000 THEN lpad(CAST(c_custkey AS VARCHAR), 12, '0') ELSE CAST(c_custkey AS VARCHAR) END AS customer_id, c_name AS customer_name, r_name AS region, c_mktsegment AS segment,"
    " CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'c' || c_custkey || '@example.com' END AS email"
    " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
_NORMAL = {"region": "upper({})", "segment": "upper({})"}


def _diff_sql() -> str:
    def side(c, s):
        return _NORMAL.get(c, "{}").format(f"{s}.{c}")

    parts = []
    for c in _DIFF_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (l.customer_id IS NOT NULL AND r.customer_id IS NOT NULL AND l.{c} IS DISTINCT FROM r.{c}) AS mismatches,"
            f" count(*) FILTER (l.customer_id IS NOT NULL AND r.customer_id IS NOT NULL AND {side(c, 'l')} IS DISTINCT FROM {side(c, 'r')}) AS normalised_mismatches,"
            " count(*) FILTER (r.customer_id IS NULL) AS only_left, count(*) FILTER (l.customer_id IS NULL) AS only_right"
            f" FROM a_customers l FULL JOIN ({_DIFF_RIGHT}) r ON r.customer_id = l.customer_id"
        )
    return f"WITH {plain.chain(upto='customers')} " + " UNION ALL ".join(parts)


def _clean_and_source(spark, sf_dir):
    cleaned = accepted(_labelled(spark, sf_dir, CANONICAL)["customers"], DIRTY.table("customers"))
    return cleaned, model_tables(spark, sf_dir)["customers"].withColumn("customer_id", F.expr(padded("C", "customer_id")))


@query("dataset_diff", _diff_sql())
def dataset_diff(spark, sf_dir):
    """Cleaned customers against their source, plain and with upper-cased labels."""
    cleaned, source = _clean_and_source(spark, sf_dir)
    rules = {c: F.upper(c) for c in _NORMAL}
    return compare.dataset_diff(cleaned, source, "customer_id", _DIFF_COLUMNS, rules)


@query("row_differences", f"WITH {plain.chain(upto='customers')}, r AS ({_DIFF_RIGHT}), d AS (SELECT customer_id, customer_name, upper(region) AS region, email, 1 AS n FROM a_customers"
       " UNION ALL SELECT customer_id, customer_name, region, email, -1 FROM r)"
       " SELECT customer_id, customer_name, region, email, CAST(sum(n) AS BIGINT) AS surplus FROM d GROUP BY ALL HAVING sum(n) <> 0")
def row_differences(spark, sf_dir):
    """Whole rows found on one side only."""
    cleaned, source = _clean_and_source(spark, sf_dir)
    columns = ["customer_id", "customer_name", "region", "email"]
    return compare.row_differences(cleaned.withColumn("region", F.upper("region")).select(*columns), source.select(*columns))


@query("key_differences", with_model(
    "SELECT (SELECT count(*) FROM m_customers WHERE customer_id NOT IN (SELECT customer_id FROM sold)) AS only_left,"
    " (SELECT count(DISTINCT customer_id) FROM sold WHERE customer_id NOT IN (SELECT customer_id FROM m_customers)) AS only_right"))
def key_differences(spark, sf_dir):
    """Customers against customers with a completed order."""
    model = model_tables(spark, sf_dir)
    return compare.key_differences(model["customers"], facts.completed_orders(model, CONFIG), "customer_id")


@query("tolerance_compare", with_model(
    "SELECT o.order_id, abs(CAST(k.o_totalprice AS DECIMAL(18,6)) - CAST(o.gross_sales AS DECIMAL(28,6))) <= 0.000001 AS equal_within"
    " FROM order_sales o JOIN orders k ON k.o_orderkey = o.order_id"))
def tolerance_compare(spark, sf_dir):
    """The header's own total against the sum of its lines, within a millionth."""
    headers = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").cast("decimal(18,6)").alias("total")
    )
    sales = facts.order_sales(model_tables(spark, sf_dir), CONFIG, keep_empty=True).select("order_id", "gross_sales")
    return sales.join(headers, "order_id").select("order_id", numbers.within(F.col("total"), F.col("gross_sales")).alias("equal_within"))


# ------------------------------------------------------------------ staging, sources and sinks


@query("staging_counts", " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM ({s}) r" for n, s in plain.RAW_SQL.items()))
def staging_counts(spark, sf_dir):
    return audit.staged_counts(_sources(spark, sf_dir), DIRTY)


def _guard_sql(name: str) -> str:
    number = "TRY_CAST(CAST(source_row AS VARCHAR) AS BIGINT)"
    return (
        f"SELECT '{name}' AS \"table\", CAST(coalesce(sum(c), 0) AS BIGINT) AS rows, CAST(coalesce(sum(c) FILTER (n IS NULL OR n < 1), 0) AS BIGINT) AS invalid_numbers,"
        f" count(*) FILTER (c > 1) AS repeated_numbers, coalesce(sum(c), 0) = 0 AS empty"
        f" FROM (SELECT {number} AS n, count(*) AS c FROM ({plain.RAW_SQL[name]}) r GROUP BY n) g"
    )


@query("staging_guard", " UNION ALL ".join(_guard_sql(n) for n in plain.RAW_SQL))
def staging_guard(spark, sf_dir):
    """Row numbers must be whole numbers from 1 and unique."""
    return audit.staging_guard(_sources(spark, sf_dir), DIRTY)


def _delivered(spark, sf_dir, names) -> str:
    """The dirty view written as CSV deliveries in the shared folder."""
    folder = shared_dir(spark, "delivery")
    raw = _sources(spark, sf_dir)
    for name in names:
        csv.write_csv(raw[name].select(*DIRTY.table(name).columns), f"{folder}/{name}.csv")
    return folder


@query("csv_scan", f"SELECT customer_id, customer_name, region, segment, nullif(email, '') AS email, FALSE AS ragged FROM ({plain.RAW_SQL['customers']}) raw")
def csv_scan(spark, sf_dir):
    """Deliveries written as CSV and scanned back as text, padding kept; empty cells read as missing."""
    columns = DIRTY.table("customers").columns
    folder = _delivered(spark, sf_dir, ["customers"])
    rows = csv.scan(spark, f"{folder}/customers.csv", columns)
    return rows.select(*[F.nullif(c, F.lit("")).alias(c) if c == "email" else F.coalesce(c, F.lit("")).alias(c) for c in columns], "ragged")


@query("csv_numbering", f"SELECT count(*) AS records, CAST(2 AS BIGINT) AS first_number, count(*) + 1 AS last_number, count(*) AS distinct_numbers FROM ({plain.RAW_SQL['orders']}) raw")
def csv_numbering(spark, sf_dir):
    """Logical record numbers over splittable CSV files are gapless and start at 2."""
    folder = _delivered(spark, sf_dir, ["orders"])
    rows = csv.scan(spark, f"{folder}/orders.csv", DIRTY.table("orders").columns, quoted_newlines=False)
    per_number = rows.groupBy("source_row").agg(F.count(F.lit(1)).alias("n"))
    return per_number.agg(
        F.sum("n").alias("records"), F.min("source_row").alias("first_number"), F.max("source_row").alias("last_number"),
        F.count(F.lit(1)).alias("distinct_numbers"),
    )


def _broken(column: str) -> str:
    """A cell with line breaks, commas and quotes in every third record."""
    text = f"coalesce(CAST({column} AS VARCHAR(1000)), '')"
    return f"CASE WHEN source_row % 3 = 0 THEN concat({text}, chr(10), {text}, ',\"x\"', chr(10)) ELSE {text} END"


def _quoted_sql(name: str) -> str:
    *others, last = DIRTY.table(name).columns
    cells = [*[f"coalesce(CAST({c} AS VARCHAR(1000)), '')" for c in others], _broken(last)]
    return (
        f"SELECT '{name}' AS \"table\", count(*) AS records, CAST(2 AS BIGINT) AS first_number, count(*) + 1 AS last_number,"
        " count(*) AS distinct_numbers, CAST(0 AS BIGINT) AS ragged,"
        f" CAST(sum({' + '.join(f'length({c})' for c in cells)}) AS BIGINT) AS characters,"
        f" CAST(sum(length({cells[-1]}) - length(replace({cells[-1]}, chr(10), ''))) AS BIGINT) AS line_breaks FROM ({plain.RAW_SQL[name]}) r"
    )


@query("csv_quoted_lines", " UNION ALL ".join(_quoted_sql(t.name) for t in DIRTY.tables))
def csv_quoted_lines(spark, sf_dir):
    """All five tables delivered with line breaks inside quotes and scanned by blocks: every record arrives
    whole, with gapless numbers."""
    folder = shared_dir(spark, "delivery")
    out = None
    for t in DIRTY.tables:
        rows = _sources(spark, sf_dir)[t.name]
        last = t.columns[-1]
        csv.write_csv(rows.withColumn(last, F.expr(_broken(last))).select(*t.columns), f"{folder}/{t.name}.csv")
        scanned = csv.scan(spark, f"{folder}/{t.name}.csv", t.columns)
        length = lambda c: F.length(F.coalesce(c, F.lit("")))
        breaks = length(last) - length(F.replace(F.coalesce(last, F.lit("")), F.lit("\n"), F.lit("")))
        per_number = scanned.groupBy("source_row").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("ragged").alias("ragged"), F.sum(sum((length(c) for c in t.columns), F.lit(0))).alias("characters"),
            F.sum(breaks).alias("line_breaks"),
        )
        counts = per_number.agg(
            F.lit(t.name).alias("table"), F.sum("n").alias("records"), F.min("source_row").alias("first_number"),
            F.max("source_row").alias("last_number"), F.count(F.lit(1)).alias("distinct_numbers"), F.sum("ragged").alias("ragged"),
            F.sum("characters").alias("characters"), F.sum("line_breaks").alias("line_breaks"),
        )
        out = counts if out is None else out.unionByName(counts)
    return out


@query("source_manifest", None)
def source_manifest(spark, sf_dir):
    """Path, SHA-256, bytes, rows and columns of every delivered file. Digests depend on file layout, so
    there is no SQL statement for it."""
    folder = _delivered(spark, sf_dir, [t.name for t in DIRTY.tables])
    return files.source_manifest(spark, folder, _sources(spark, sf_dir), DIRTY)


_ANNUAL = with_model(
    f"SELECT '1995-01-01 to before 2002-01-01' AS analysis_period, k.completed_orders, k.purchasing_customers, k.sold_units, k.returned_units,"
    " CAST(k.net_sales AS VARCHAR) AS net_sales, (SELECT count(*) FROM m_orders WHERE status = 'Cancelled') AS cancelled_orders_excluded,"
    f" (SELECT category FROM ({bundle_sql('category')}) c ORDER BY net_sales DESC, category LIMIT 1) AS top_category,"
    f" (SELECT region FROM ({bundle_sql('region')}) r ORDER BY net_sales DESC, region LIMIT 1) AS top_region FROM ({bundle_sql('')}) k"
)


@query("json_summary", _ANNUAL)
def json_summary(spark, sf_dir):
    """The nested business summary written as JSON and read back."""
    path = shared_dir(spark, "summary")
    model = facts.prepared(model_tables(spark, sf_dir), CONFIG, settler(spark), line_ids=False)
    files.write_json(reports.business_summary(model, CONFIG), path)
    schema = (
        "analysis_period STRING, kpis STRUCT<completed_orders: BIGINT, purchasing_customers: BIGINT, sold_units: BIGINT, returned_units: BIGINT,"
        " net_sales: STRING, cancelled_orders_excluded: BIGINT>, findings MAP<STRING, STRUCT<member: STRING, value: STRING>>"
    )
    summary = spark.read.schema(schema).json(path)
    kpi = F.col("kpis")
    return summary.select(
        "analysis_period",
        *[kpi[c].alias(c) for c in ("completed_orders", "purchasing_customers", "sold_units", "returned_units")],
        kpi["net_sales"].cast(MEASURE).cast("string").alias("net_sales"),
        kpi["cancelled_orders_excluded"].alias("cancelled_orders_excluded"),
        F.col("findings")["top_category"]["member"].alias("top_category"),
        F.col("findings")["top_region"]["member"].alias("top_region"),
    )


@query("sql_views", with_model(
    "SELECT channel, count(*) AS lines, CAST(sum(net_sales) AS DECIMAL(28,6)) AS net_sales,"
    " (SELECT count(*) FROM order_sales o WHERE o.channel = s.channel) AS completed_orders FROM sales s GROUP BY channel"))
def sql_views(spark, sf_dir):
    """The session views used from SQL text."""
    facts.register_views(spark, model_tables(spark, sf_dir), CONFIG)
    return spark.sql(
        "SELECT l.channel, l.lines, l.net_sales, o.completed_orders FROM"
        " (SELECT channel, count(*) AS lines, CAST(sum(net_sales) AS DECIMAL(28,6)) AS net_sales FROM line_sales GROUP BY channel) l"
        " JOIN (SELECT channel, count(*) AS completed_orders FROM order_sales GROUP BY channel) o ON o.channel = l.channel"
    )


@query("run_stamp", None)
def run_stamp(spark, sf_dir):
    """Totals with the engine version, database and time of the run; the time has no fixed answer."""
    totals = reports.kpis(model_tables(spark, sf_dir), CONFIG)
    return totals.select(
        F.version().alias("engine_version"), F.current_database().alias("database_name"), F.current_timestamp().alias("verified_at"),
        *MONEY, *UNITS,
    )

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tables import CONFIG, parents
from tallyforge.plans import checks, reports
from tallyforge.plans import model as facts
from tallyforge.plans.metrics import metrics, monthly_summary, trend

EVENTS = "return_id STRING, order_line_id STRING, return_date DATE, return_quantity INT, reason STRING"
ORDERS = "order_id STRING, customer_id STRING, order_date DATE, channel STRING, status STRING"
LINES = "order_line_id STRING, order_id STRING, product_id STRING, quantity INT, unit_price DECIMAL(12,2), discount_rate DECIMAL(5,4)"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


@pytest.fixture(scope="module")
def shop(spark):
    """Three customers (one without purchase), tied products, an order without lines, a cancelled one."""
    customers = spark.createDataFrame(
        [("C1", "A", "East", "Consumer", None), ("C2", "B", "West", "Business", "b@x"), ("C3", "C", "West", "Business", None)],
        "customer_id STRING, customer_name STRING, region STRING, segment STRING, email STRING")
    products = spark.createDataFrame(
        [(p, f"n{p}", c, D("10.00")) for p, c in [("P1", "Chairs"), ("P2", "Chairs"), ("P3", "Lamps"), ("P4", "Lamps")]],
        "product_id STRING, product_name STRING, category STRING, list_price DECIMAL(12,2)")
    orders = spark.createDataFrame([
        ("O1", "C1", date(2025, 1, 5), "Online", "Completed"), ("O2", "C1", date(2025, 1, 5), "Store", "Completed"),
        ("O3", "C1", date(2025, 3, 1), "Online", "Completed"), ("O4", "C2", date(2025, 3, 9), "Store", "Completed"),
        ("O5", "C2", date(2025, 3, 9), "Store", "Cancelled"), ("O6", "C2", date(2025, 4, 1), "Store", "Completed")], ORDERS)
    lines = spark.createDataFrame([
        ("L1", "O1", "P1", 2, D("10.00"), D("0")), ("L2", "O1", "P2", 2, D("10.00"), D("0")), ("L3", "O2", "P3", 1, D("100.00"), D("0.5")),
        ("L4", "O3", "P1", 5, D("10.00"), D("0.1")), ("L5", "O4", "P4", 1, D("7.00"), D("0")), ("L6", "O5", "P4", 9, D("9.00"), D("0"))], LINES)
    returned = events(spark, ("R1", "L4", date(2025, 3, 2), 2, "Damaged"), ("R2", "L4", date(2025, 3, 3), 1, "Wrong Item"),
                      ("R3", "L4", date(2026, 2, 1), 1, "Late"))
    return {"customers": customers, "products": products, "orders": orders, "order_lines": lines, "returns": returned}


def by(frame, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()}


def test_several_returns_keep_one_fact_row(spark):
    model = {**parents(spark), "returns": events(spark, ("R81", "L640219", date(2025, 6, 20), 1, "x"), ("R82", "L640219", date(2025, 7, 4), 4, "x"))}
    rows = facts.line_facts(model, CONFIG).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["returned_units"], row["return_events"], row["latest_return_date"], row["net_sales"], row["order_month"]) == (
        5, 2, date(2025, 7, 4), D("140.40"), "2025-06")
    assert [c for c in facts.line_facts(model, CONFIG).columns if c.endswith("source_row")] == [
        "line_source_row", "order_source_row", "customer_source_row", "product_source_row"]
    assert len(facts.line_facts(model, CONFIG).columns) == 32


def test_cancelled_lines_stay_but_do_not_count(spark, shop):
    flags = by(facts.line_facts(shop, CONFIG), "order_line_id", "include_in_sales_kpi")
    assert flags["L6"] is False and sum(flags.values()) == 5
    assert tuple(reports.excluded(shop, CONFIG).first()) == (1, 1)


def test_kpis_and_order_bases(shop):
    lines_based = reports.kpis(shop, CONFIG).first()
    # 20 + 20 + 50 + 45 + 7 less 3 returned at 9
    assert (lines_based["net_sales"], lines_based["completed_orders"], lines_based["purchasing_customers"]) == (D("115"), 4, 2)
    header_based = reports.annual_kpis(shop, CONFIG).first()
    assert header_based["completed_orders"] == 5
    assert header_based["order_period"] == "2025-01-01 through 2025-12-31"


def test_metrics_of_nothing(shop):
    row = metrics(facts.sales_lines(shop, CONFIG).filter("1 = 0")).first()
    assert (row["net_sales"], row["completed_orders"], row["aov"], row["unit_return_rate"]) == (0, 0, None, None)


def test_staged_distinct_counts(shop):
    got = by(reports.category_summary(shop, CONFIG), "category", "completed_orders", "purchasing_customers", "net_sales")
    assert got == {"Chairs": (2, 1, D("58")), "Lamps": (2, 2, D("57"))}


def test_region_and_customer_summaries(shop):
    assert by(reports.region_summary(shop, CONFIG), "region", "completed_orders", "net_sales") == {"East": (3, D("108")), "West": (1, D("7"))}
    customers = by(reports.customer_summary(shop, CONFIG), "customer_id", "completed_orders", "net_sales_share", "aov", "is_repeat_customer")
    assert customers["C3"] == (0, 0, None, False)
    assert customers["C1"][0] == 3 and customers["C1"][3] is True
    repeat = reports.repeat_customers(shop, CONFIG, keep_empty=False).first()
    assert (repeat["purchasing_customers"], repeat["repeat_customers"], repeat["repeat_customer_net_sales"]) == (2, 1, D("108"))


def test_ranks_keep_ties(shop):
    # net per product: P1 38, P2 20, P3 50, P4 7
    ranks = by(reports.product_summary_ranked(shop, CONFIG), "product_id", "net_sales_rank")
    assert ranks == {"P3": 1, "P1": 2, "P2": 3, "P4": 4}
    tied = {**shop, "order_lines": shop["order_lines"].filter("order_line_id IN ('L1', 'L2', 'L5')")}
    assert by(reports.product_summary_ranked(tied, CONFIG), "product_id", "net_sales_rank") == {"P1": 1, "P2": 1, "P4": 2}
    assert by(reports.top_products(tied, CONFIG, ranks=1), "product_id", "net_sales_rank") == {"P1": 1, "P2": 1}
    assert by(reports.top_products_per_category(tied, CONFIG, ranks=1), "product_id", "category_rank") == {"P1": 1, "P2": 1, "P4": 1}


def test_month_spine_growth_and_trailing_mean(spark, shop):
    rows = reports.monthly(shop, CONFIG).collect()
    assert [r["order_month"] for r in rows] == [f"2025-{m:02d}" for m in range(1, 13)]
    january, february, march, april = rows[:4]
    assert (january["net_sales"], january["mom_growth"], january["trailing_3_month_avg"]) == (D("90"), None, None)
    assert (february["net_sales"], february["aov"], february["net_sales_share"], february["mom_growth"]) == (0, None, 0, -1)
    assert march["mom_growth"] is None and march["trailing_3_month_avg"].quantize(D("0.0001")) == D("38.3333")
    zero = reports.monthly(shop, CONFIG, zero_default=True).collect()
    assert (zero[0]["mom_growth"], zero[1]["aov"], zero[2]["mom_growth"]) == (0, 0, 0)
    running = trend(facts.order_sales(shop, CONFIG, keep_empty=True), facts.months(spark, CONFIG)).collect()
    assert [r["running_net_sales"] for r in running[:4]] == [90, 90, 115, 115]
    assert [r["completed_orders"] for r in running[:4]] == [2, 0, 2, 1]


def test_returning_at_purchase_needs_an_earlier_day(shop):
    rows = by(reports.returning_at_purchase(shop, CONFIG), "month_start", "returning_at_purchase_net_sales", "returning_at_purchase_share")
    assert rows[date(2025, 1, 1)][0] == 0
    assert rows[date(2025, 3, 1)][0] == D("18")
    assert rows[date(2025, 4, 1)] == (0, None)


def test_order_sequence(shop):
    assert by(reports.order_sequence(shop, CONFIG), "order_id", "observed_order_sequence") == {"O1": 1, "O2": 2, "O3": 3, "O4": 1, "O6": 2}


def test_refunds_by_reason(shop):
    got = by(reports.refund_by_reason(shop, CONFIG), "reason", "refunds", "returned_units", "return_events")
    assert got == {"Damaged": (D("18"), 2, 1), "Wrong Item": (D("9"), 1, 1)}


def test_findings_prefer_the_first_key_on_ties(shop):
    found = by(reports.findings(shop, CONFIG), "finding", "member")
    assert found["peak_month"] == "2025-01" and found["lowest_month"] == "2025-02"
    assert found["top_category"] == "Chairs" and found["top_region"] == "East"


def test_groups_of_one_pass_equal_each_summary(shop):
    got = reports.additive_groups(shop, CONFIG).collect()
    summaries = {
        "category_summary": (reports.category_summary, "category"), "product_summary": (reports.product_summary, "product_id"),
        "channel_summary": (reports.channel_summary, "channel"), "region_summary": (reports.region_summary, "region"),
        "customer_summary": (reports.customer_totals, "customer_id"), "monthly_summary": (reports.monthly_totals, "month_start"),
    }
    for name, (build, key) in summaries.items():
        plain = {(str(r[key]), *[r[m] for m in facts.MEASURES]) for r in build(shop, CONFIG).collect()}
        found = {tuple(r[1:]) for r in got if r["summary"] == name}
        # A summary of all customers also lists those without a purchase.
        assert found == {p for p in plain if any(p[1:])}, name
    assert {r["net_sales"] for r in got if r["summary"] in ("lines", "order_summary")} == {D("115")}


def test_reconciliation_notices_planted_gaps(spark, shop):
    passed = lambda model: {n[10:] for n, ok in by(checks.reconcile_summaries(model, CONFIG), "check", "passed").items() if not ok}
    assert passed(shop) == set()
    # An unknown customer is missing from the summaries that need its attributes.
    assert passed({**shop, "customers": shop["customers"].filter("customer_id <> 'C2'")}) == {"order_summary", "region_summary"}
    # A stored fact that lost an order.
    totals = facts.order_totals(shop, CONFIG).filter("order_id <> 'O4'")
    orders = {"order_summary", "monthly_summary", "channel_summary", "region_summary", "customer_summary"}
    assert passed({**shop, "order_totals": totals}) == orders
    nothing = {**shop, "order_lines": shop["order_lines"].filter("1 = 0")}
    assert len(checks.reconcile_summaries(nothing, CONFIG).collect()) == 7 and passed(nothing) == set()


def test_what_if(spark):
    model = parents(spark)
    one = model["order_lines"].withColumn("quantity", F.lit(1)).withColumn("discount_rate", F.lit("0.2").cast("decimal(5,4)"))
    model = {**model, "order_lines": one, "returns": spark.createDataFrame([], EVENTS)}
    overrides = one.select("order_line_id", (F.col("unit_price") + 10).alias("unit_price"))
    assert by(reports.what_if(model, CONFIG, overrides), "measure", "change")["net_sales"] == D("8")


def test_checks_report_and_raise(spark, shop):
    got = by(checks.all_checks(shop, CONFIG), "check", "passed")
    # An order without lines and a late event are real differences, everything else holds.
    assert {n for n, ok in got.items() if not ok} == {"completed_orders_have_lines", "return_quantities_reconcile"}
    with pytest.raises(checks.ValidationError, match="completed_orders_have_lines"):
        checks.enforce(checks.completed_orders_have_lines(shop, CONFIG))
    assert by(checks.return_parent_rules(shop, CONFIG), "rule", "violations")["after_cutoff"] == 1


def test_calendar(spark):
    days = facts.calendar(spark, CONFIG)
    assert days.count() == 365 and days.select("month_start").distinct().count() == 12
    assert days.first()["month_name"] == "Jan"


def test_reports_on_a_shop_without_sales(shop):
    empty = {**shop, "order_lines": shop["order_lines"].filter("1 = 0"), "returns": shop["returns"].filter("1 = 0")}
    for report in (reports.product_summary_ranked, reports.top_products, reports.category_summary, reports.refund_by_reason):
        assert report(empty, CONFIG).count() == 0
    months = reports.monthly(empty, CONFIG).collect()
    assert len(months) == 12 and {(r["net_sales"], r["mom_growth"], r["net_sales_share"]) for r in months} == {(0, None, 0)}
    assert by(reports.customer_summary(empty, CONFIG), "customer_id", "net_sales", "is_repeat_customer")["C1"] == (0, False)
    repeat = reports.repeat_customers(empty, CONFIG, keep_empty=False).first()
    assert (repeat["purchasing_customers"], repeat["repeat_customer_rate"]) == (0, None)


def test_orders_are_counted_only_for_products_on_the_ranks(spark, shop, monkeypatch):
    lines = shop["order_lines"].unionByName(spark.createDataFrame([("L7", "O4", "P2", 3, D("10.00"), D("0"))], LINES))
    model = {**shop, "order_lines": lines}
    want = by(reports.product_summary(model, CONFIG), "product_id", "net_sales", "completed_orders", "purchasing_customers", "aov", "net_sales_share")
    counted = []
    monkeypatch.setattr(reports, "metrics", lambda sales, *a, **k: counted.append(sales.count()) or metrics(sales, *a, **k))
    top = reports.top_products(model, CONFIG, ranks=1)
    got = by(top, "product_id", "net_sales", "completed_orders", "purchasing_customers", "aov", "net_sales_share")
    assert got == {p: want[p] for p in ("P2", "P3")} and counted == [3]
    assert top.columns == [*reports.product_summary(model, CONFIG).columns, "net_sales_rank"]


def test_top_products_keep_repeated_and_unnamed_products(spark, shop):
    more = spark.createDataFrame([("P3", None, "Lamps", D("1.00")), ("P3", "nP3", "Lamps", D("1.00"))], shop["products"].schema)
    model = {**shop, "products": shop["products"].unionByName(more)}
    rows = {tuple(r) for r in reports.top_products(model, CONFIG, ranks=9).drop("net_sales_rank").collect()}
    assert rows == {tuple(r) for r in reports.product_summary(model, CONFIG).collect()} and len(rows) == 5


def _shuffles(spark, frame, key):
    """Shuffles by ``key`` in the plan when nothing is broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = frame()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return sum(f"Exchange hashpartitioning({key}#" in line for line in plan.splitlines())


def test_facts_lie_by_line_and_lines_are_not_shuffled_by_customer(spark, shop):
    per_line = lambda: facts.line_facts(shop, CONFIG).groupBy("order_line_id").agg(F.sum("refunds"))
    assert _shuffles(spark, per_line, "order_line_id") == 2 and _shuffles(spark, per_line, "order_id") == 2


def test_line_ids_are_not_stored_for_reports(spark, shop):
    stored = {}
    lean = facts.prepared(shop, CONFIG, lambda name, frame: stored.setdefault(name, frame), line_ids=False)
    assert "order_line_id" not in stored["sales_lines"].columns
    assert checks.all_checks(lean, CONFIG).exceptAll(checks.all_checks(shop, CONFIG)).count() == 0
    assert "order_line_id" in facts.prepared(shop, CONFIG, lambda name, frame: frame)["sales_lines"].columns

"""The fixed set of business reports. Each takes a model and a run configuration."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import RunConfig
from ..functions.numbers import MEASURE, money_ratio, ratio, ratio_or_zero
from ..operators.ranking import global_dense_rank, sequence_in_group, top_per_group, top_values
from ..session import settler
from .metrics import BUNDLE, finish, grand_total, metrics, monthly_summary, on_spine, summary, trend, with_share
from .model import (
    MEASURES, UNITS, Model, _returned_lines, _with_measures, completed_orders, fold, measures, months, order_sales,
    order_totals, sales_lines,
)


# ------------------------------------------------------------------ totals


def annual_kpis(model: Model, config: RunConfig) -> DataFrame:
    """One row: sums over lines, order count over headers (orders without lines included)."""
    totals = metrics(order_sales(model, config, keep_empty=True), grain="order")
    last = F.date_sub(F.lit(config.order_before), 1).cast("string")
    return totals.select(
        F.lit("USD").alias("currency"),
        F.concat(F.lit(config.order_from.isoformat() + " through "), last).alias("order_period"),
        F.lit(config.return_cutoff).alias("return_cutoff"),
        *MEASURES,
        "completed_orders",
        F.col("aov").alias("net_aov"),
        "unit_return_rate",
    )


def kpis(model: Model, config: RunConfig) -> DataFrame:
    """The bundle over orders seen on lines."""
    return metrics(order_sales(model, config, keep_empty=False), grain="order")


def excluded(model: Model, config: RunConfig) -> DataFrame:
    """Cancelled headers and the lines that do not reach the sales base."""
    orders = model["orders"]
    void = orders.filter(F.col("status") == config.void_status)
    lines = model["order_lines"].select("order_id")
    sold = completed_orders(model, config).select("order_id")
    left_out = lines.join(sold, "order_id", "left_anti")
    return one_row(
        void.agg(F.count(F.lit(1)).alias("cancelled_orders_excluded")),
        left_out.agg(F.count(F.lit(1)).alias("cancelled_lines_excluded")),
    )


def one_row(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Side by side: each input is a single aggregate row and arrives as scalar subqueries."""
    for other in others:
        first = first.withColumns({c: other.select(c).scalar() for c in other.columns})
    return first


# ------------------------------------------------------------------ summaries


def order_summary(model: Model, config: RunConfig) -> DataFrame:
    """One row per completed order with its customer's attributes and share of net sales."""
    sales = order_sales(model, config, keep_empty=False)
    counted = sales.withColumns(
        {"completed_orders": F.lit(1).cast("bigint"), "purchasing_customers": F.lit(1).cast("bigint")}
    )
    attributes = ["customer_id", "order_date", "month_start", "channel"]
    rows = with_share(finish(counted, ["order_id", *attributes]))
    return rows.join(model["customers"].select("customer_id", "region", "segment"), "customer_id")


def category_summary(model: Model, config: RunConfig) -> DataFrame:
    return summary(sales_lines(model, config), ["category"]).orderBy("category")


def category_contribution(model: Model, config: RunConfig) -> DataFrame:
    """Net sales, units, orders touching the category, share and return rate, best first."""
    rows = summary(sales_lines(model, config), ["category"])
    return rows.select(
        "category",
        "net_sales",
        "sold_units",
        "returned_units",
        F.col("completed_orders").alias("completed_orders_with_category"),
        "net_sales_share",
        "unit_return_rate",
    ).orderBy(F.desc("net_sales"), "category")


def product_summary(model: Model, config: RunConfig) -> DataFrame:
    """The bundle per product. Sales fold to one row per product before product attributes join."""
    slim = {**model, "products": model["products"].select("product_id", "product_name", "category")}
    return summary(sales_lines(slim, config), ["product_id", "product_name", "category"])


def product_summary_ranked(model: Model, config: RunConfig) -> DataFrame:
    """All products with their global dense rank by net sales. The summary is stored first, since the
    ranking reads it three times."""
    products = settler(model["products"].sparkSession)("product_summary", product_summary(model, config))
    return global_dense_rank(products, "net_sales", "net_sales_rank")


def top_products(model: Model, config: RunConfig, ranks: int = 5) -> DataFrame:
    """Products on the first dense ranks, ties kept, with their summary. Ranks and the total come from plain
    sums of all products; orders and customers are counted only for products on these ranks."""
    settle = settler(model["products"].sparkSession)
    keys = ["product_id", "product_name", "category"]
    totals = settle("product_totals", product_totals(model, config))
    best = settle("top_products", top_values(totals.select(*keys, "net_sales"), "net_sales", ranks, "net_sales_rank"))
    base = "sales_lines" if "sales_lines" in model else "order_lines"
    picked = {**model, base: model[base].join(best.select("product_id").distinct(), "product_id", "left_semi")}
    counted = metrics(sales_lines(picked, config), keys)
    named = best.select("net_sales_rank", *[F.col(k).alias(f"_{k}") for k in keys])
    rows = counted.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.select(
        *keys, *BUNDLE, money_ratio(F.col("net_sales"), grand_total(totals, "net_sales")).alias("net_sales_share"), "net_sales_rank"
    )


def product_totals(model: Model, config: RunConfig) -> DataFrame:
    """Sums per product without distinct counts: one shuffle, ratios left out."""
    return fold(sales_lines(model, config), ["category", "product_id", "product_name"])


def top_products_per_category(model: Model, config: RunConfig, ranks: int = 3) -> DataFrame:
    totals = product_totals(model, config).select(
        "category", "product_id", "product_name", "net_sales", "sold_units", "returned_units"
    )
    return top_per_group(totals, "category", "net_sales", ranks, "category_rank")


def top_products_by_refund(model: Model, config: RunConfig, count: int = 10) -> DataFrame:
    totals = product_totals(model, config).select("product_id", "product_name", "category", "refunds", "returned_units")
    return totals.orderBy(F.desc("refunds"), "product_id").limit(count)


def channel_summary(model: Model, config: RunConfig, *, keep_empty: bool = False) -> DataFrame:
    """Per channel, with ratios of channel sums. ``keep_empty`` counts headers without lines too."""
    return summary(order_sales(model, config, keep_empty=keep_empty), ["channel"], grain="order").orderBy("channel")


def customer_totals(model: Model, config: RunConfig, *, keep_empty: bool = False) -> DataFrame:
    """Sums and order count per purchasing customer."""
    sales = order_sales(model, config, keep_empty=keep_empty)
    return fold(sales, ["customer_id"], completed_orders=F.count(F.lit(1)))


def region_summary(model: Model, config: RunConfig) -> DataFrame:
    """Per region. Sales fold per customer first, so the customer join sees one row per customer."""
    placed = customer_totals(model, config).join(model["customers"].select("customer_id", "region"), "customer_id")
    folded = fold(
        placed, ["region"], completed_orders=F.sum("completed_orders"), purchasing_customers=F.count(F.lit(1))
    )
    return with_share(finish(folded, ["region"])).orderBy("region")


def customer_summary(model: Model, config: RunConfig) -> DataFrame:
    """All customers; those without a purchase get zeros, undefined ratios and no repeat flag."""
    active = customer_totals(model, config).withColumn("purchasing_customers", F.lit(1).cast("bigint"))
    active = with_share(finish(active, ["customer_id"]))
    everyone = model["customers"].select("customer_id", "customer_name", "region", "segment")
    money = [m for m in MEASURES if not m.endswith("_units")]
    return (
        everyone.join(active, "customer_id", "left")
        .withColumns({m: F.coalesce(m, F.lit(0).cast(MEASURE)) for m in money})
        .fillna(0, subset=["sold_units", "returned_units", "completed_orders", "purchasing_customers"])
        .withColumns(
            {
                "net_sales_share": F.coalesce("net_sales_share", F.lit(0)),
                "is_repeat_customer": F.col("completed_orders") >= 2,
            }
        )
        .select("customer_id", "customer_name", "region", "segment", *BUNDLE, "net_sales_share", "is_repeat_customer")
    )


def repeat_customers(model: Model, config: RunConfig, *, keep_empty: bool = True) -> DataFrame:
    """Customers with at least two completed orders: how many, their rate, sales and share."""
    totals = customer_totals(model, config, keep_empty=keep_empty)
    repeat = F.col("completed_orders") >= 2
    counted = totals.agg(
        F.count(F.lit(1)).alias("purchasing_customers"),
        F.count_if(repeat).alias("repeat_customers"),
        F.coalesce(F.sum(F.when(repeat, F.col("net_sales"))), F.lit(0)).cast(MEASURE).alias("repeat_customer_net_sales"),
        F.sum("net_sales").cast(MEASURE).alias("_all"),
    )
    return counted.select(
        "purchasing_customers",
        "repeat_customers",
        ratio(F.col("repeat_customers").cast("decimal(18,6)"), F.col("purchasing_customers")).alias("repeat_customer_rate"),
        "repeat_customer_net_sales",
        money_ratio(F.col("repeat_customer_net_sales"), F.col("_all")).alias("repeat_customer_sales_share"),
    )


# ------------------------------------------------------------------ time


def _spine(model: Model, config: RunConfig) -> DataFrame:
    return months(model["orders"].sparkSession, config)


def monthly(model: Model, config: RunConfig, *, zero_default: bool = False) -> DataFrame:
    sales = order_sales(model, config, keep_empty=False)
    return monthly_summary(sales, _spine(model, config), zero_default=zero_default)


def monthly_trend(model: Model, config: RunConfig) -> DataFrame:
    return trend(order_sales(model, config, keep_empty=True), _spine(model, config))


def returning_at_purchase(model: Model, config: RunConfig) -> DataFrame:
    """Monthly sales placed strictly after the customer's first observed order date.

    Orders fold to (customer, day), then to (customer, month) with the month's first day kept apart; only
    that day can be a first date, so no join back to single orders is needed. A customer's window holds
    one row per month."""
    sales = order_sales(model, config, keep_empty=True)
    daily = sales.groupBy("customer_id", "month_start", "order_date").agg(F.sum("net_sales").cast(MEASURE).alias("net"))
    per_month = daily.groupBy("customer_id", "month_start").agg(
        F.sum("net").cast(MEASURE).alias("net"), F.min_by("net", "order_date").alias("first_net"), F.min("order_date").alias("first_day")
    )
    debut = F.min("first_day").over(W.partitionBy("customer_id"))
    split = per_month.withColumn(
        "later", F.col("net") - F.when(F.col("first_day") == debut, F.col("first_net")).otherwise(F.lit(0))
    )
    folded = split.groupBy("month_start").agg(
        F.sum("net").cast(MEASURE).alias("net_sales"),
        F.sum("later").cast(MEASURE).alias("returning_at_purchase_net_sales"),
    )
    share = money_ratio(F.col("returning_at_purchase_net_sales"), F.col("net_sales"))
    filled = on_spine(_spine(model, config), folded.withColumn("returning_at_purchase_share", share))
    zero = F.coalesce("returning_at_purchase_net_sales", F.lit(0).cast(MEASURE))
    return filled.withColumn("returning_at_purchase_net_sales", zero).orderBy("month_start")


def order_sequence(model: Model, config: RunConfig) -> DataFrame:
    """Running order number per customer by date, then order id."""
    orders = order_sales(model, config, keep_empty=True).select(
        "customer_id", "order_id", "order_date", "month_start", "net_sales"
    )
    numbered = sequence_in_group(
        orders, "customer_id", "order_date", ["order_id"], "observed_order_sequence"
    )
    return numbered.drop("month_start")


def refund_trend(model: Model, config: RunConfig) -> DataFrame:
    """Refunds and returned units by order month."""
    sales = order_sales(model, config, keep_empty=False)
    folded = sales.groupBy("month_start").agg(
        F.sum("refunds").cast(MEASURE).alias("refunds"), F.sum("returned_units").alias("returned_units"),
        F.sum("sold_units").alias("sold_units"),
    )
    rate = ratio(F.col("returned_units").cast("decimal(18,6)"), F.col("sold_units"))
    return on_spine(_spine(model, config), folded).withColumn("unit_return_rate", rate).orderBy("month_start")


def period_decomposition(model: Model, config: RunConfig) -> DataFrame:
    """Month against month: what orders and order value each contributed."""
    ordered = W.orderBy("month_start")
    base = trend(order_sales(model, config, keep_empty=True), _spine(model, config))
    prior_orders, prior_aov = F.lag("completed_orders").over(ordered), F.lag("net_aov").over(ordered)
    return base.select(
        "month_start",
        "completed_orders",
        "net_aov",
        (F.col("completed_orders") - prior_orders).alias("orders_change"),
        (F.col("net_aov") - prior_aov).alias("aov_change"),
        ratio((F.col("completed_orders") - prior_orders).cast("decimal(18,6)"), prior_orders).alias("orders_change_rate"),
        ratio(F.col("net_aov") - prior_aov, prior_aov).alias("aov_change_rate"),
        F.col("mom_net_sales_growth").alias("net_change_rate"),
    ).orderBy("month_start")


# ------------------------------------------------------------------ returns and comparisons


def refund_by_reason(model: Model, config: RunConfig) -> DataFrame:
    """Refund money, units and events per reason at event grain, with both shares.

    Events fold per (line, reason) before they meet their line."""
    events = (
        model["returns"]
        .filter(F.col("return_date") <= F.lit(config.return_cutoff))
        .groupBy("order_line_id", "reason")
        .agg(F.sum(F.col("return_quantity").cast("bigint")).alias("units"), F.count(F.lit(1)).alias("events"))
    )
    sold = completed_orders(model, config).select("order_id")
    lines = model["order_lines"].select("order_line_id", "order_id", "unit_price", "discount_rate")
    priced = events.join(lines, "order_line_id").join(sold, "order_id")
    refund = measures(F.lit(0), F.col("units"), F.col("unit_price"), F.col("discount_rate"))["refunds"]
    by_reason = priced.groupBy("reason").agg(
        F.sum(refund).cast(MEASURE).alias("refunds"),
        F.sum("units").alias("returned_units"),
        F.sum("events").alias("return_events"),
    )
    shared = with_share(by_reason, "refunds", "refund_share")
    events_total = grand_total(by_reason, "return_events")
    return shared.withColumn(
        "event_share", ratio(F.col("return_events").cast("decimal(18,6)"), events_total)
    ).orderBy(F.desc("refunds"), "reason")


def return_rate_by_category(model: Model, config: RunConfig) -> DataFrame:
    folded = fold(sales_lines(model, config), ["category"])
    rate = ratio_or_zero(F.col("returned_units").cast("decimal(18,6)"), F.col("sold_units"))
    return folded.select("category", "sold_units", "returned_units", rate.alias("unit_return_rate")).orderBy("category")


def group_vs_overall(model: Model, config: RunConfig) -> DataFrame:
    """Channels and regions against the whole: order value gap and return rate gap in points."""
    whole = kpis(model, config)
    whole_aov, whole_rate = whole.select("aov").scalar(), whole.select("unit_return_rate").scalar()
    parts = [
        channel_summary(model, config).select(F.lit("channel").alias("dimension"), F.col("channel").alias("member"), "*"),
        region_summary(model, config).select(F.lit("region").alias("dimension"), F.col("region").alias("member"), "*"),
    ]
    groups = [p.select("dimension", "member", "completed_orders", "aov", "unit_return_rate") for p in parts]
    return reduce(DataFrame.unionByName, groups).select(
        "*",
        (F.col("aov") - whole_aov).alias("aov_gap"),
        ((F.col("unit_return_rate") - whole_rate) * 100).alias("return_rate_gap_points"),
    )


def region_order_pivot(model: Model, config: RunConfig, statuses: list[str] | None = None) -> DataFrame:
    """Distinct orders per region, one column per status. Orders are unique, so a count per customer and
    status is folded before customers join."""
    words = statuses or [config.sale_status, config.void_status]
    orders = model["orders"].groupBy("customer_id", "status").agg(F.count_distinct("order_id").alias("orders"))
    placed = orders.join(model["customers"].select("customer_id", "region"), "customer_id")
    pivot = placed.groupBy("region").pivot("status", words).agg(F.sum("orders"))
    return pivot.fillna(0).select("region", *[F.col(w).alias(f"{w.lower()}_orders") for w in words])


def additive_groups(model: Model, config: RunConfig, names: Sequence[str] | None = None) -> DataFrame:
    """The seven sums per member of every summary: summary, member (as text) and the measures.

    Both facts are read once. Lines fold to products, orders to customer, month and channel, and grouping
    sets run over these folds, so nothing but folded rows is repeated for each set. The rows of ``lines``
    and ``order_summary`` are totals: of all lines, and of all orders whose customer is known.
    """
    products = fold(sales_lines(model, config), ["product_id", "category"])
    placed = fold(order_sales(model, config, keep_empty=False), ["customer_id", "month_start", "channel"]).join(
        model["customers"].select("customer_id", "region", F.lit(True).alias("known")), "customer_id", "left"
    )
    by_line = {"lines": [], "category_summary": ["category"], "product_summary": ["product_id"]}
    by_order = {
        "order_summary": ["known"], "monthly_summary": ["month_start"], "channel_summary": ["channel"],
        "region_summary": ["known", "region"], "customer_summary": ["customer_id"],
    }
    wanted = {*by_line, *by_order} if names is None else set(names)
    sides = [(products, {k: v for k, v in by_line.items() if k in wanted}), (placed, {k: v for k, v in by_order.items() if k in wanted})]
    groups = [_grouping_sets(rows, sets) for rows, sets in sides if sets]
    return reduce(DataFrame.unionByName, groups)


def _grouping_sets(rows: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """One row per summary and member; a set with ``known`` leaves out what lacks it."""
    keys = list(dict.fromkeys(k for s in sets.values() for k in s))
    sums = [F.sum(m).cast("bigint" if m in UNITS else MEASURE).alias(m) for m in MEASURES]
    if not keys:
        return rows.agg(*sums).select(F.lit(next(iter(sets))).alias("summary"), F.lit(None).cast("string").alias("member"), *MEASURES)
    grouped = rows.groupingSets([[F.col(k) for k in s] for s in sets.values()], *keys).agg(F.grouping_id().alias("_set"), *sums)
    # A key that is not in the set has its bit, the first key the highest.
    bits = {name: sum(1 << i for i, k in enumerate(reversed(keys)) if k not in s) for name, s in sets.items()}
    chosen = [F.when(F.col("_set") == b, F.lit(name)) for name, b in bits.items()]
    member = [F.when(F.col("_set") == bits[name], F.col(s[-1]).cast("string")) for name, s in sets.items() if s[-1:] not in ([], ["known"])]
    named = grouped.withColumns({"summary": F.coalesce(*chosen), "member": F.coalesce(*member)})
    partial = [name for name, s in sets.items() if "known" in s]
    if partial:
        named = named.filter(~F.col("summary").isin(partial) | F.col("known"))
    return named.select("summary", "member", *MEASURES)


def findings(model: Model, config: RunConfig) -> DataFrame:
    """Best and worst of the small summaries. Ties go to the first key; a NULL rate counts as zero.

    One pass over the groups: each extreme is the least pair of (signed) value and key."""
    groups = additive_groups(model, config, ["category_summary", "monthly_summary", "channel_summary", "region_summary"])
    groups = groups.select("summary", "member", *[F.col(c).cast("decimal(38,10)") for c in ("net_sales", "sold_units", "returned_units")])
    none = [F.lit(0).cast("decimal(38,10)").alias(c) for c in ("net_sales", "sold_units", "returned_units")]
    empty = _spine(model, config).select(F.lit("monthly_summary").alias("summary"), F.col("month_start").cast("string").alias("member"), *none)
    filled = groups.unionByName(empty).groupBy("summary", "member").agg(
        *[F.sum(c).cast("decimal(38,10)").alias(c) for c in ("net_sales", "sold_units", "returned_units")]
    )
    rate = F.coalesce(ratio(F.col("returned_units").cast("decimal(18,6)"), F.col("sold_units").cast("decimal(18,6)")), F.lit(0)).cast("decimal(38,10)")
    valued = filled.withColumns({"rate": rate, "member": F.when(F.col("summary") == "monthly_summary", F.substring("member", 1, 7)).otherwise(F.col("member"))})
    least = lambda value: F.min(F.struct(value.alias("value"), F.col("member").alias("member")))
    ends = valued.groupBy("summary").agg(
        least(-F.col("net_sales")).alias("top"), least(F.col("net_sales")).alias("low"), least(-F.col("rate")).alias("rate")
    )
    wanted = [
        ("peak_month", "monthly_summary", "top"), ("lowest_month", "monthly_summary", "low"), ("top_category", "category_summary", "top"),
        ("highest_return_rate_category", "category_summary", "rate"), ("top_channel", "channel_summary", "top"),
        ("top_region", "region_summary", "top"),
    ]
    cells = [
        F.when(F.col("summary") == summary, F.struct(
            F.lit(name).alias("finding"), F.col(end)["member"].alias("member"),
            (F.col(end)["value"] * (1 if end == "low" else -1)).cast("decimal(38,10)").alias("value"),
        ))
        for name, summary, end in wanted
    ]
    return ends.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*")


def monthly_totals(model: Model, config: RunConfig) -> DataFrame:
    return fold(order_sales(model, config, keep_empty=False), ["month_start"])


# ------------------------------------------------------------------ scenarios


def apply_overrides(lines: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace quantity, price, rate or returned units of listed lines; NULL keeps the base value."""
    changed = ["quantity", "unit_price", "discount_rate", "returned_units"]
    renamed = overrides.select(
        "order_line_id", *[F.col(c).cast(lines.schema[c].dataType).alias(f"_new_{c}") for c in changed if c in overrides.columns]
    )
    joined = lines.join(renamed, "order_line_id", "left")
    for c in changed:
        if f"_new_{c}" in joined.columns:
            joined = joined.withColumn(c, F.coalesce(f"_new_{c}", c)).drop(f"_new_{c}")
    return joined


def what_if(model: Model, config: RunConfig, overrides: DataFrame) -> DataFrame:
    """All totals before and after the overrides, and the difference, one row per measure."""
    base = _returned_lines(model, config)
    before = _scenario_total(model, config, base)
    after = _scenario_total(model, config, apply_overrides(base, overrides))
    return before.join(after.withColumnRenamed("value", "scenario"), "measure").select(
        "measure",
        F.col("value").alias("base"),
        "scenario",
        (F.col("scenario") - F.col("value")).cast(MEASURE).alias("change"),
    )


def _scenario_total(model: Model, config: RunConfig, lines: DataFrame) -> DataFrame:
    sold = completed_orders(model, config).select("order_id")
    totals = fold(_with_measures(lines).join(sold, "order_id"), [])
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast(MEASURE).alias("value")) for m in MEASURES])
    return totals.select(F.explode(cells).alias("cell")).select("cell.*")


def business_summary(
    model: Model, config: RunConfig, quality: DataFrame | None = None, *, sources: DataFrame | None = None, passed: DataFrame | None = None
) -> DataFrame:
    """One nested row: period, cutoff, totals, repeat customers, exclusions, findings, top products,
    quality, sources and the outcome of the checks, ready for a JSON sink. Every list in it has as many
    entries as there are tables, files or ranks."""
    repeats = repeat_customers(model, config, keep_empty=False).select(
        "repeat_customers", "repeat_customer_rate", "repeat_customer_net_sales",
        F.col("repeat_customer_sales_share").alias("repeat_sales_share"),
    )
    totals = one_row(kpis(model, config), excluded(model, config), repeats)
    found = findings(model, config).agg(
        F.map_from_entries(F.collect_list(F.struct("finding", F.struct("member", "value")))).alias("findings")
    )
    row = totals.select(
        F.lit(f"{config.order_from.isoformat()} to before {config.order_before.isoformat()}").alias("analysis_period"),
        F.lit(config.return_cutoff.isoformat()).alias("return_cutoff"),
        F.lit("USD").alias("currency"),
        F.struct("*").alias("kpis"),
    )
    ranked = F.struct("net_sales_rank", "product_id", "product_name", "category", "net_sales", "sold_units", "returned_units")
    best = top_products(model, config).agg(F.sort_array(F.collect_list(ranked)).alias("top_products"))
    row = row.withColumns({"findings": found.scalar(), "top_products": best.scalar()})
    lists = {"quality": quality, "sources": sources}
    for name, frame in lists.items():
        if frame is not None:
            row = row.withColumn(name, frame.agg(F.collect_list(F.struct("*"))).scalar())
    return row if passed is None else row.withColumn("validation_passed", passed.scalar())

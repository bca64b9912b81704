"""Reconciliation checks: each yields rows (check, passed, detail) and never moves row data to the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import RunConfig, TableSpec
from ..functions.dates import in_window, month_start
from ..functions.numbers import MEASURE, within
from ..operators.compare import key_differences, missing_keys, union_all
from . import reports
from .model import MEASURES, Model, _returned_lines, calendar, completed_orders, fold, line_facts, months, order_sales, returned_by_line, sales_lines


def _check(frame: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    return frame.select(
        F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.cast("string").alias("detail")
    )


def unique_keys(model: Model, config: RunConfig) -> DataFrame:
    """Rows against distinct keys, per table."""
    checks = []
    for t in config.tables:
        per_key = model[t.name].groupBy(t.key).agg(F.count(F.lit(1)).alias("n"))
        counted = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"))
        checks.append(_check(counted, f"unique_{t.name}_keys", F.col("repeated") == 0, F.concat("rows", F.lit(" clean rows"))))
    return union_all(checks)


def row_accounting(quality: DataFrame) -> DataFrame:
    """raw = clean + duplicates + rejected, for every table."""
    return _check(
        quality.agg(F.bool_and("accounting_passed").alias("ok"), F.count(F.lit(1)).alias("tables")),
        "raw_row_accounting", F.col("ok"), F.concat("tables", F.lit(" tables")),
    )


def join_fanout(model: Model, config: RunConfig) -> DataFrame:
    """The wide facts must have exactly one row per clean line."""
    per_line = line_facts(model, config).groupBy("order_line_id").agg(F.count(F.lit(1)).alias("n"))
    facts = per_line.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("facts"), F.count_if(F.col("n") > 1).alias("repeated"))
    both = reports.one_row(facts, model["order_lines"].agg(F.count(F.lit(1)).alias("lines")))
    return _check(
        both, "no_fact_join_fanout", (F.col("facts") == F.col("lines")) & (F.col("repeated") == 0),
        F.concat("facts", F.lit(" joined facts / "), "lines", F.lit(" clean lines")),
    )


def order_grain(model: Model, config: RunConfig) -> DataFrame:
    """Order sales hold one row per completed order."""
    rows = order_sales(model, config, keep_empty=True).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    counted = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"))
    both = reports.one_row(counted, completed_orders(model, config).agg(F.count(F.lit(1)).alias("orders")))
    return _check(
        both, "one_row_per_completed_order", (F.col("rows") == F.col("orders")) & (F.col("repeated") == 0),
        F.concat("rows", F.lit(" rows / "), "orders", F.lit(" orders")),
    )


def completed_orders_have_lines(model: Model, config: RunConfig) -> DataFrame:
    """The completed headers and the orders seen on sales lines are the same set."""
    headers = completed_orders(model, config)
    seen = model["order_lines"].select("order_id").join(headers.select("order_id"), "order_id", "left_semi")
    sides = key_differences(headers, seen, "order_id")
    return _check(
        sides, "completed_orders_have_lines", (F.col("only_left") == 0) & (F.col("only_right") == 0),
        F.concat("only_left", F.lit(" orders without lines")),
    )


def orphans(model: Model, config: RunConfig) -> DataFrame:
    """Child rows without a parent, one row per reference."""
    references = [(t.name, p.table, p.column) for t in config.tables for p in t.parents]
    references.append(("returns", "order_lines", "order_line_id"))
    return union_all(
        [
            missing_keys(model[child], column, model[parent])
            .agg(F.count(F.lit(1)).alias("orphans"))
            .select(F.lit(child).alias("child"), F.lit(parent).alias("parent"), "orphans")
            for child, parent, column in references
        ]
    )


def foreign_keys(model: Model, config: RunConfig) -> DataFrame:
    total = orphans(model, config).agg(F.sum("orphans").alias("orphans"))
    return _check(total, "all_foreign_keys_valid", F.col("orphans") == 0, F.concat("orphans", F.lit(" orphans")))


def returns_bounded(model: Model, config: RunConfig) -> DataFrame:
    """Returned units of a line lie between zero and its quantity."""
    lines = _returned_lines(model, config)
    bad = lines.agg(F.count_if(~F.col("returned_units").between(0, F.col("quantity"))).alias("bad"))
    return _check(bad, "cumulative_return_quantity_bounded", F.col("bad") == 0, F.concat("bad", F.lit(" lines out of bounds")))


def returns_reconcile(model: Model, config: RunConfig) -> DataFrame:
    """Units over accepted events equal the returned units of all sales lines."""
    events = model["returns"].agg(F.coalesce(F.sum("return_quantity"), F.lit(0)).alias("events"))
    both = reports.one_row(events, reports.kpis(model, config).select("returned_units"))
    return _check(
        both, "return_quantities_reconcile", F.col("events") == F.col("returned_units"),
        F.concat("events", F.lit(" units in events / "), "returned_units", F.lit(" in sales")),
    )


def line_identity(model: Model, config: RunConfig) -> DataFrame:
    """gross - discounts - refunds = net, exactly, and again through the remaining quantity."""
    left = (F.col("sold_units") - F.col("returned_units")).cast("int")
    other = (left * F.col("unit_price") * (F.lit(1).cast("decimal(1,0)") - F.col("discount_rate"))).cast(MEASURE)
    net, parts = F.col("net_sales"), F.col("gross_sales") - F.col("discounts") - F.col("refunds")
    bad = sales_lines(model, config).agg(F.count_if((parts != net) | (other != net)).alias("bad"))
    return _check(bad, "line_sales_identity", F.col("bad") == 0, F.concat("bad", F.lit(" lines differ")))


def calendar_complete(model: Model, config: RunConfig) -> DataFrame:
    """All days and months of the window, with attributes that match their dates."""
    spark = model["orders"].sparkSession
    day = F.col("calendar_date")
    wrong = (
        (F.col("calendar_year") != F.year(day)) | (F.col("month_number") != F.month(day)) | (F.col("month_start") != month_start(day))
    )
    days = (config.order_before - config.order_from).days
    counted = calendar(spark, config).agg(
        F.count(F.lit(1)).alias("days"),
        F.count_distinct("month_start").alias("months"),
        F.min(day).alias("first"),
        F.max(day).alias("last"),
        F.count_if(wrong).alias("wrong"),
    )
    both = reports.one_row(counted, months(spark, config).agg(F.count(F.lit(1)).alias("spine")))
    ok = (
        (F.col("days") == days) & (F.col("months") == F.col("spine")) & (F.col("first") == F.lit(config.order_from))
        & (F.col("last") == F.date_sub(F.lit(config.order_before), 1)) & (F.col("wrong") == 0)
    )
    return _check(both, "calendar_complete", ok, F.concat("days", F.lit(" days, "), "months", F.lit(" months")))


SUMMARIES = ["order_summary", "monthly_summary", "category_summary", "product_summary", "channel_summary", "region_summary", "customer_summary"]


def reconcile_summaries(model: Model, config: RunConfig) -> DataFrame:
    """Per summary: its seven additive measures against the line totals. One pass over each fact gives the
    groups of all summaries (``reports.additive_groups``)."""
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast("decimal(38,6)").alias(m) for m in MEASURES]
    # A summary without any row adds up to zero.
    nothing = model["orders"].sparkSession.createDataFrame([("lines",), *[(n,) for n in SUMMARIES]], "summary STRING")
    rows = reports.additive_groups(model, config).unionByName(nothing, allowMissingColumns=True)
    folded = rows.groupBy("summary").agg(F.struct(*sums).alias("sums"))
    # Eight rows, one of which is the total.
    total = F.col("sums").getField
    whole = F.max(F.when(F.col("summary") == "lines", F.col("sums"))).over(W.partitionBy(F.lit(1)))
    both = folded.withColumn("total", whole).filter(F.col("summary") != "lines")
    gap = F.greatest(*[F.abs(total(m) - F.col("total")[m]).cast("decimal(38,6)") for m in MEASURES])
    return both.select(
        F.concat(F.lit("reconcile_"), "summary").alias("check"), (gap == 0).alias("passed"), F.concat(F.lit("largest gap "), gap).alias("detail")
    )


def totals_reconcile(model: Model, config: RunConfig) -> DataFrame:
    """Monthly, order and line totals agree within the database tolerance."""
    lines = fold(sales_lines(model, config), []).select(F.col("net_sales").alias("by_line"))
    orders = order_sales(model, config, keep_empty=True)
    by_order = orders.agg(F.sum("net_sales").alias("by_order"))
    by_month = reports.monthly_trend(model, config).agg(F.sum("net_sales").alias("by_month"))
    row = reports.one_row(lines, by_order, by_month)
    ok = within(F.col("by_order"), F.col("by_line")) & within(F.col("by_month"), F.col("by_line"))
    return _check(row, "monthly_order_line_totals", ok, F.concat(F.lit("net "), F.col("by_line")))


def status_counts(model: Model, config: RunConfig) -> DataFrame:
    return model["orders"].groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


def return_parent_rules(model: Model, config: RunConfig) -> DataFrame:
    """Events in the model that break a parent rule, per rule."""
    lines = model["order_lines"].select("order_line_id", "order_id", "quantity")
    parents = lines.join(model["orders"].select("order_id", "status", "order_date"), "order_id", "left")
    events = model["returns"].join(parents, "order_line_id", "left")
    day = F.col("return_date")
    flat = events.agg(
        F.count_if(F.col("quantity").isNull()).alias("unknown_line"),
        F.count_if(F.col("status") != config.sale_status).alias("order_not_completed"),
        F.count_if(day < F.col("order_date")).alias("before_order_date"),
        F.count_if(day > F.lit(config.return_cutoff)).alias("after_cutoff"),
    )
    folded = model["returns"].groupBy("order_line_id").agg(F.sum(F.col("return_quantity").cast("bigint")).alias("units"))
    over = folded.join(lines, "order_line_id").agg(F.count_if(F.col("units") > F.col("quantity")).alias("units_over_quantity"))
    row = reports.one_row(flat, over)
    cells = F.array(*[F.struct(F.lit(c).alias("rule"), F.col(c).alias("violations")) for c in row.columns])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def constraint_rules(spec: TableSpec, config: RunConfig) -> dict[str, Column]:
    """Column rules of one clean table as conditions that must never be true."""
    rules: dict[str, Column] = {}
    for f in spec.fields:
        value = F.col(f.name)
        if f.kind != "email":
            rules[f"{f.name} not null"] = value.isNull()
        if f.domain:
            rules[f"{f.name} in domain"] = ~value.isin(list(f.domain))
        if f.kind in ("price", "count"):
            rules[f"{f.name} positive"] = value <= 0
        if f.kind == "rate":
            rules[f"{f.name} in [0,1]"] = ~value.between(0, 1)
        if f.name == "order_date":
            rules["order_date in window"] = ~in_window(value, config.order_from, config.order_before)
        if f.name == "return_date":
            rules["return_date up to cutoff"] = value > F.lit(config.return_cutoff)
    return rules


def constraint_violations(model: Model, config: RunConfig) -> DataFrame:
    """Violations per table and rule; each table is read once for all its rules. Repeated keys count too."""
    lines = []
    for t in config.tables:
        rules = constraint_rules(t, config)
        counted = model[t.name].agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
        cells = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
        per_rule = counted.select(F.explode(cells).alias("cell")).select("cell.*")
        repeated = (
            model[t.name].groupBy(t.key).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("violations"))
            .select(F.lit(f"{t.key} unique").alias("rule"), "violations")
        )
        lines.append(per_rule.unionByName(repeated).select(F.lit(t.name).alias("table"), "*"))
    return union_all(lines)


def length_rules(spec: TableSpec) -> dict[str, Column]:
    """Length rules of one clean table, as conditions that must never be true."""
    rules: dict[str, Column] = {}
    for f in spec.fields:
        if f.length:
            rules[f"{f.name} length"] = F.length(f.name) > f.length
        if f.max_length:
            rules[f"{f.name} length"] = F.length(f.name) > f.max_length
    return rules


def rule_checks(model: Model, config: RunConfig) -> DataFrame:
    """Rules of parents, columns and lengths as checks: none may be broken in an accepted row."""
    broken = [
        return_parent_rules(model, config).select(F.concat(F.lit("returns "), "rule").alias("rule"), "violations"),
        constraint_violations(model, config).select(F.concat_ws(" ", "table", "rule").alias("rule"), "violations"),
    ]
    for t in config.tables:
        if rules := length_rules(t):
            counted = model[t.name].agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
            cells = F.array(*[F.struct(F.lit(f"{t.name} {n}").alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
            broken.append(counted.select(F.explode(cells).alias("cell")).select("cell.*"))
    rows = union_all(broken)
    return rows.select(
        F.concat(F.lit("rule: "), "rule").alias("check"), (F.col("violations") == 0).alias("passed"),
        F.concat(F.col("violations"), F.lit(" violations")).alias("detail"),
    )


def staging_checks(guard: DataFrame) -> DataFrame:
    """The staging guard as checks: rows are there, and their numbers are whole, positive and unique."""
    ok = ~F.col("empty") & (F.col("invalid_numbers") == 0) & (F.col("repeated_numbers") == 0)
    detail = F.concat_ws(" ", "rows", F.lit("rows,"), "invalid_numbers", F.lit("invalid,"), "repeated_numbers", F.lit("repeated numbers"))
    return guard.select(F.concat(F.lit("staging_"), "table").alias("check"), ok.alias("passed"), detail.alias("detail"))


def staged_all_labelled(spark: SparkSession, staged: Mapping[str, int], quality: DataFrame) -> DataFrame:
    """Every staged row was labelled: the rows that the writes of either stage counted are the same."""
    rows = F.create_map(*[x for name, n in staged.items() for x in (F.lit(name), F.lit(n).cast("bigint"))])
    counted = quality.withColumn("staged_rows", rows[F.col("table")])
    return counted.select(
        F.concat(F.lit("staged_all_labelled_"), "table").alias("check"),
        F.coalesce(F.col("staged_rows") == F.col("raw_rows"), F.lit(False)).alias("passed"),
        F.concat_ws(" ", "staged_rows", F.lit("staged,"), "raw_rows", F.lit("labelled")).alias("detail"),
    )


def actual_measures(model: Model, config: RunConfig, quality: DataFrame | None = None) -> DataFrame:
    """Counts and totals in the (measure, actual) form that expectations use."""
    names = ["completed_orders", "gross_sales", "discounts", "refunds", "net_sales", "sold_units", "returned_units"]
    totals = reports.kpis(model, config)
    cells = [F.struct(F.lit(n).alias("measure"), F.col(n).cast("string").alias("actual")) for n in names]
    cells.append(F.struct(F.lit("aov").alias("measure"), F.col("aov").cast("string").alias("actual")))
    rows = totals.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    if quality is None:
        return rows
    groups = ["raw_rows", "clean_rows", "duplicate_rows_removed", "rejected_rows"]
    counts = F.array(
        *[F.struct(F.concat(F.lit(g + ":"), "table").alias("measure"), F.col(g).cast("string").alias("actual")) for g in groups]
    )
    return rows.unionByName(quality.select(F.explode(counts).alias("cell")).select("cell.*"))


def all_checks(model: Model, config: RunConfig, quality: DataFrame | None = None) -> DataFrame:
    """Every check of a run as one frame."""
    parts = [
        unique_keys(model, config),
        join_fanout(model, config),
        order_grain(model, config),
        completed_orders_have_lines(model, config),
        foreign_keys(model, config),
        returns_bounded(model, config),
        returns_reconcile(model, config),
        line_identity(model, config),
        calendar_complete(model, config),
        reconcile_summaries(model, config),
        totals_reconcile(model, config),
    ]
    if quality is not None:
        parts.append(row_accounting(quality))
    return union_all(parts)


def expectation_checks(compared: DataFrame) -> DataFrame:
    """Expected values as checks. Raw counts are compared where the expectations name them."""
    compared = compared.filter(F.col("expected").isNotNull() | ~F.startswith("measure", F.lit("raw_rows:")))
    detail = F.concat(F.lit("expected "), F.coalesce("expected", F.lit("nothing")), F.lit(", actual "), F.coalesce("actual", F.lit("nothing")))
    return compared.select(F.concat(F.lit("benchmark_"), "measure").alias("check"), "passed", detail.alias("detail"))


class ValidationError(AssertionError):
    """A run whose checks did not all pass."""


def enforce(checks: DataFrame) -> None:
    """Raise with the names of failed checks. The frame holds one row per check, not data."""
    failed = [r["check"] for r in checks.filter(~F.col("passed")).select("check").collect()]
    if failed:
        raise ValidationError(f"validation failed: {sorted(failed)}")

"""Facts over the clean model.

A model is a mapping of the five clean tables. Every function returns a lazy DataFrame; parent joins
carry no hints, so Spark broadcasts a parent only after measuring it and splits skewed partitions of a
fact otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..functions.dates import in_window, month_key, month_start
from ..functions.numbers import MEASURE

Model = Mapping[str, DataFrame]

UNITS = ["sold_units", "returned_units"]
MEASURES = ["gross_sales", "discounts", "sales_before_returns", "refunds", "net_sales", *UNITS]


def calendar(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Every day of the order window with its month attributes."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(config.order_from), F.date_sub(F.lit(config.order_before), 1), F.expr("interval 1 day"))
        ).alias("calendar_date")
    ).select("calendar_date", *_calendar_parts())


def _calendar_parts() -> list[Column]:
    day = F.col("calendar_date")
    return [
        F.year(day).alias("calendar_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMM").alias("month_name"),
        month_start(day).alias("month_start"),
    ]


def months(spark: SparkSession, config: RunConfig) -> DataFrame:
    """The month spine: one row per month of the window, which bounds every frame built on it."""
    last = F.date_sub(F.lit(config.order_before), 1)
    spine = F.sequence(month_start(F.lit(config.order_from)), month_start(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(spine).alias("month_start"))


def returned_by_line(returns: DataFrame, config: RunConfig) -> DataFrame:
    """Return events folded to one row per line. Folding before the join is what keeps a line with
    several events from being counted several times."""
    return (
        returns.filter(F.col("return_date") <= F.lit(config.return_cutoff))
        .groupBy("order_line_id")
        .agg(
            F.sum(F.col("return_quantity").cast("bigint")).alias("returned_units"),
            F.count(F.lit(1)).alias("return_events"),
            F.max("return_date").alias("latest_return_date"),
        )
    )


def measures(quantity: Column, returned: Column, price: Column, rate: Column) -> dict[str, Column]:
    """The five money measures of one line, exact."""
    gross = (quantity * price).cast(MEASURE)
    discounts = (quantity * price * rate).cast(MEASURE)
    refunds = (returned.cast("int") * price * (F.lit(1).cast("decimal(1,0)") - rate)).cast(MEASURE)
    return {
        "gross_sales": gross,
        "discounts": discounts,
        "sales_before_returns": (gross - discounts).cast(MEASURE),
        "refunds": refunds,
        "net_sales": (gross - discounts - refunds).cast(MEASURE),
    }


def _with_returned(lines: DataFrame, model: Model, config: RunConfig) -> DataFrame:
    returned = returned_by_line(model["returns"], config)
    return lines.join(returned, "order_line_id", "left").fillna(0, subset=["returned_units", "return_events"])


def _returned_lines(model: Model, config: RunConfig) -> DataFrame:
    return _with_returned(model["order_lines"], model, config)


def _with_measures(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        measures(F.col("quantity"), F.col("returned_units"), F.col("unit_price"), F.col("discount_rate"))
    ).withColumn("sold_units", F.col("quantity").cast("bigint"))


def line_facts(model: Model, config: RunConfig, *, by_line: bool = True) -> DataFrame:
    """One wide row per clean order line, cancelled orders included and flagged.

    Orders meet their customers first, so lines are not shuffled for them. Returns come last, so the facts lie
    by line and a fold by line shuffles nothing more. Without ``by_line``, for facts that are stored whole,
    returns come first and the wide columns of orders last, so that no shuffle carries those of a line."""
    rows = {name: f"{name[:-1] if name != 'order_lines' else 'line'}_source_row" for name in model}

    def table(name: str) -> DataFrame:
        frame = model[name]
        return frame.withColumnRenamed("source_row", rows[name]) if "source_row" in frame.columns else frame

    placed = table("orders").join(table("customers"), "customer_id")
    if by_line:
        lines = table("order_lines").join(placed, "order_id").join(table("products"), "product_id")
        facts = _with_returned(lines, model, config)
    else:
        lines = _with_returned(table("order_lines"), model, config)
        facts = lines.join(table("products"), "product_id").join(placed, "order_id")
    kept = [c for c in ("line_source_row", "order_source_row", "customer_source_row", "product_source_row")]
    return _with_measures(facts).select(
        "order_line_id", "order_id", "customer_id", "customer_name", "region", "segment", "email",
        "order_date", month_key(F.col("order_date")).alias("order_month"), "channel", "status",
        (F.col("status") == config.sale_status).alias("include_in_sales_kpi"),
        "product_id", "product_name", "category", "list_price",
        "quantity", "unit_price", "discount_rate", "return_events", "latest_return_date",
        *MEASURES,
        *[c for c in kept if c in facts.columns],
    )


def completed_orders(model: Model, config: RunConfig) -> DataFrame:
    """Headers that count as sales; both predicates reach the scan."""
    orders = model["orders"]
    return orders.filter(
        (F.col("status") == config.sale_status)
        & in_window(F.col("order_date"), config.order_from, config.order_before)
    ).select("order_id", "customer_id", "order_date", month_start(F.col("order_date")).alias("month_start"), "channel")


def sales_lines(model: Model, config: RunConfig) -> DataFrame:
    """One row per line of a completed order with product attributes and measures. Only lines of completed
    orders are shuffled for their returns, and line ids no further than that unless somebody reads them."""
    if "sales_lines" in model:
        return model["sales_lines"]
    sold = model["order_lines"].join(completed_orders(model, config), "order_id")
    joined = _with_returned(sold, model, config).join(
        model["products"].select("product_id", "product_name", "category"), "product_id"
    )
    return _with_measures(joined).select(
        "order_line_id", "order_id", "customer_id", "order_date", "month_start", "channel",
        "product_id", "product_name", "category", "unit_price", "discount_rate", *MEASURES,
    )


def order_totals(model: Model, config: RunConfig) -> DataFrame:
    """Line measures folded to one row per order id. Partial aggregation runs before the shuffle, so an
    order with very many lines weighs no more than any other."""
    if "order_totals" in model:
        return model["order_totals"]
    return _fold(_with_measures(_returned_lines(model, config)), ["order_id"])


def order_sales(model: Model, config: RunConfig, *, keep_empty: bool) -> DataFrame:
    """One row per completed order. ``keep_empty`` keeps headers without lines as zeros; otherwise only
    orders seen on lines count."""
    how = "left" if keep_empty else "inner"
    joined = completed_orders(model, config).join(order_totals(model, config), "order_id", how)
    return joined.fillna(0, subset=UNITS).withColumns(
        {m: F.coalesce(m, F.lit(0).cast(MEASURE)) for m in MEASURES if m not in UNITS}
    )


# Only three money sums and two unit sums are accumulated; the other two follow from them exactly.
_SUMMED = ["gross_sales", "discounts", "refunds", *UNITS]


def _fold(rows: DataFrame, keys: list[str], **more: Column) -> DataFrame:
    """Group sums of the seven additive measures plus further aggregates."""
    sums = [F.sum(m).cast("bigint" if m in UNITS else MEASURE).alias(m) for m in _SUMMED]
    grouped = rows.groupBy(*keys) if keys else rows
    return with_derived(grouped.agg(*sums, *[c.alias(n) for n, c in more.items()]))


def with_derived(folded: DataFrame) -> DataFrame:
    before = (F.col("gross_sales") - F.col("discounts")).cast(MEASURE)
    return folded.withColumns(
        {"sales_before_returns": before, "net_sales": (before - F.col("refunds")).cast(MEASURE)}
    )


fold = _fold


def prepared(model: Model, config: RunConfig, settle, *, line_ids: bool = True) -> Model:
    """The model with its two facts stored. Many reports over one model then share one pass over the
    lines; ``settle(name, frame)`` writes a frame and returns the stored copy. No report reads the ids of
    sales lines: without ``line_ids`` they are neither carried through the joins nor stored."""
    lines = sales_lines(model, config)
    lines = settle("sales_lines", lines if line_ids else lines.drop("order_line_id"))
    return {**model, "sales_lines": lines, "order_totals": settle("order_totals", _fold(lines, ["order_id"]))}


def register_views(spark: SparkSession, model: Model, config: RunConfig, quality: DataFrame | None = None) -> None:
    """Session views for SQL users: ``line_sales``, ``order_sales`` and, with a summary of the cleaning,
    ``quality_summary``."""
    sales_lines(model, config).createOrReplaceTempView("line_sales")
    order_sales(model, config, keep_empty=True).createOrReplaceTempView("order_sales")
    if quality is not None:
        quality.select(
            F.col("table").alias("source_table"), "raw_rows", F.col("clean_rows").alias("accepted_rows"),
            F.col("duplicate_rows_removed").alias("duplicate_rows"), "rejected_rows",
        ).createOrReplaceTempView("quality_summary")

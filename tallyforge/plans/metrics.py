"""The metric bundle for any grouping, and the shares, growth and trends built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..functions.numbers import MEASURE, money_ratio, ratio, ratio_or_zero
from .model import MEASURES, fold

BUNDLE = [*MEASURES, "completed_orders", "purchasing_customers", "aov", "unit_return_rate"]


def metrics(sales: DataFrame, by: Sequence[str] = (), *, grain: str = "line", zero_default: bool = False) -> DataFrame:
    """Seven sums, distinct orders, distinct customers, average order value and unit return rate.

    Distinct counts are exact and come from folding in steps, (group, order) then (group, customer) then
    group: each step aggregates partially before its shuffle, a hot group shrinks at once, and the rows
    are never expanded once per distinct column. Input of ``grain='order'`` skips the first step.
    """
    keys = list(by)
    step = sales
    if grain == "line":
        step = fold(step, _unique([*keys, "order_id", "customer_id"]))
    if "order_id" in keys:
        counted = step.withColumns({"completed_orders": F.lit(1).cast("bigint"), "purchasing_customers": F.lit(1).cast("bigint")})
    else:
        per_customer = fold(step, _unique([*keys, "customer_id"]), completed_orders=F.count(F.lit(1)))
        if "customer_id" in keys:
            counted = per_customer.withColumn("purchasing_customers", F.lit(1).cast("bigint"))
        else:
            counted = fold(
                per_customer,
                keys,
                completed_orders=F.sum("completed_orders"),
                purchasing_customers=F.count(F.lit(1)),
            )
            if not keys:
                counted = _zero_filled(counted)
    return finish(counted, keys, zero_default=zero_default)


def finish(counted: DataFrame, keys: Sequence[str], *, zero_default: bool = False) -> DataFrame:
    """Add the two ratios and put the bundle in order."""
    divide = ratio_or_zero if zero_default else ratio
    return counted.withColumns(
        {
            "aov": divide(F.col("net_sales"), F.col("completed_orders")),
            "unit_return_rate": divide(
                F.col("returned_units").cast("decimal(18,6)"), F.col("sold_units").cast("decimal(18,6)")
            ),
        }
    ).select(*keys, *BUNDLE)


def _zero_filled(totals: DataFrame) -> DataFrame:
    money = {m: F.coalesce(m, F.lit(0).cast(MEASURE)) for m in MEASURES if not m.endswith("_units")}
    return totals.withColumns(money).fillna(0, subset=["sold_units", "returned_units", "completed_orders"])


def _unique(names: list[str]) -> list[str]:
    return list(dict.fromkeys(names))


ADDITIVE = [*MEASURES, "completed_orders", "purchasing_customers", "return_events"]


def grand_total(groups: DataFrame, value: str) -> Column:
    """The sum of one column as a scalar subquery. It adds up every additive column, because a subquery
    that needs the same columns as the groups reuses their shuffles instead of running them again."""
    sums = [F.sum(c).alias(c) for c in groups.columns if c in ADDITIVE]
    return groups.agg(F.struct(*sums).alias("total")).scalar()[value]


def with_share(groups: DataFrame, value: str = "net_sales", name: str = "net_sales_share") -> DataFrame:
    """Part of the grand total, NULL when that is zero. The groups stay distributed however many there
    are."""
    return groups.withColumn(name, money_ratio(F.col(value), grand_total(groups, value)))


def summary(sales: DataFrame, by: Sequence[str], *, grain: str = "line") -> DataFrame:
    return with_share(metrics(sales, by, grain=grain))


def filtered_metrics(sales: DataFrame, context: Column | None, by: Sequence[str] = ()) -> DataFrame:
    """A measure under a filter context: slice first, then the bundle per drill-down level."""
    return metrics(sales if context is None else sales.filter(context), by)


def on_spine(spine: DataFrame, monthly: DataFrame) -> DataFrame:
    """All months of the spine; months without sales get zeros, their ratios stay NULL."""
    money = [m for m in MEASURES if not m.endswith("_units")]
    filled = spine.join(monthly, "month_start", "left")
    counts = [c for c in ("sold_units", "returned_units", "completed_orders", "purchasing_customers") if c in filled.columns]
    return filled.withColumns({m: F.coalesce(m, F.lit(0).cast(MEASURE)) for m in money if m in filled.columns}).fillna(
        0, subset=counts
    )


def monthly_summary(sales: DataFrame, spine: DataFrame, *, grain: str = "order", zero_default: bool = False) -> DataFrame:
    """The bundle per month on the spine with share, growth and trailing mean. Windows run over spine
    rows only, one per month of the window."""
    monthly = on_spine(spine, summary(sales, ["month_start"], grain=grain))
    by_month = W.orderBy("month_start")
    previous = F.lag("net_sales").over(by_month)
    growth = money_ratio(F.col("net_sales") - previous, previous)
    result = monthly.withColumns(
        {
            "order_month": month_key(F.col("month_start")),
            "net_sales_share": F.coalesce("net_sales_share", F.lit(0)),
            "previous_net_sales": previous,
            "mom_growth": F.coalesce(growth, F.lit(0)) if zero_default else growth,
            "trailing_3_month_avg": trailing_mean("net_sales", by_month),
        }
    )
    if zero_default:
        result = result.fillna(0, subset=["aov", "unit_return_rate"])
    return result.orderBy("month_start")


def trailing_mean(value: str, ordered, size: int = 3) -> Column:
    """Mean over the last ``size`` rows, NULL until that many exist."""
    frame = ordered.rowsBetween(-(size - 1), 0)
    return F.when(
        F.count(F.lit(1)).over(frame) == size, (F.sum(value).over(frame) / size).cast("decimal(38,10)")
    )


def trend(order_sales: DataFrame, spine: DataFrame) -> DataFrame:
    """Orders and net sales per month with both growth rates, running total and trailing mean."""
    monthly = order_sales.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("completed_orders"), F.sum("net_sales").cast(MEASURE).alias("net_sales")
    )
    by_month = W.orderBy("month_start")
    prior_sales, prior_orders = F.lag("net_sales").over(by_month), F.lag("completed_orders").over(by_month)
    orders = F.col("completed_orders")
    return (
        on_spine(spine, monthly)
        .withColumns(
            {
                "net_aov": ratio(F.col("net_sales"), orders),
                "mom_net_sales_growth": money_ratio(F.col("net_sales") - prior_sales, prior_sales),
                "mom_order_growth": ratio((orders - prior_orders).cast("decimal(18,6)"), prior_orders),
                "running_net_sales": F.sum("net_sales").over(by_month.rowsBetween(W.unboundedPreceding, 0)).cast(MEASURE),
                "moving_average_3_months": trailing_mean("net_sales", by_month),
            }
        )
        .orderBy("month_start")
    )

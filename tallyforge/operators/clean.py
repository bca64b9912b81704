"""One labelled frame per table: every raw row gets exactly one disposition and its reasons."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SQL_DIALECT, RunConfig, TableSpec
from ..functions import numbers
from ..functions.text import longer_than
from .identity import hot_keys, read_identified
from .normalize import Finding, field_findings, field_value, first_reason, reason_text

ACCEPTED, DUPLICATE, REJECTED = "Accepted", "Duplicate", "Rejected"

# Reasons for whole rows.
COPY_REASON = "duplicate business record (source row excluded)"
CONFLICT_REASON = "conflicting business records for key"
PARENT_REASON = "unknown or rejected"
UNKNOWN_LINE_REASON = "order_line_id: unknown or rejected line"
NOT_COMPLETED_REASON = "order_id: return requires completed order"
TOO_EARLY_REASON = "return_date: precedes order date"
TOO_LATE_REASON = "return_date: after {cutoff} cutoff"
TOO_MANY_REASON = "return_quantity: event exceeds purchased quantity"
CUMULATIVE_REASON = (
    "return_quantity: cumulative valid events exceed purchased quantity; whole group quarantined"
)
RAGGED_REASON = "record: field count differs from header"

# Reasons of the SQL dialect, of which a row gets the first that applies.
SQL_COPY_REASON = "Exact duplicate of original business fields"
SQL_CONFLICT_REASON = "Conflicting records share a normalized business key"
SQL_BAD_KEY = "Invalid {}"
SQL_BAD_TEXT = "Missing or overlength {}"
SQL_UNKNOWN_WORD = "Unrecognized {}"
SQL_ORPHAN = "Unknown or rejected {}"
SQL_BAD_PRICE = "{} must be a positive number"
SQL_BAD_COUNT = "{} must be a positive integer"
SQL_BAD_RATE = "Discount must be between zero and one"
SQL_TOO_PRECISE = "{} is outside the model precision"
SQL_BAD_DATE = "Invalid {} date: require ISO yyyy-MM-dd or US MM/dd/yyyy"
SQL_OUTSIDE_WINDOW = "Order date is outside {}"
SQL_NOT_COMPLETED = "Returns require a completed order"
SQL_TOO_EARLY = "Return date precedes order date"
SQL_TOO_LATE = "Return date is after the {} cutoff"
SQL_TOO_MANY = "Individual return quantity exceeds purchased units"
SQL_CUMULATIVE_REASON = (
    "Cumulative otherwise-valid returns exceed purchased units; review all events on line"
)


def clean_table(
    raw: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], config: RunConfig, settle=None
) -> DataFrame:
    """Check parents, read, deduplicate and label ``raw``.

    ``parents`` maps table names to accepted rows. A raw frame may carry a boolean ``ragged`` column;
    such rows are rejected for it. ``settle(name, frame)`` stores a frame and returns the stored copy;
    returns use it because the cumulative bound reads the checked events twice.

    Rows meet their parents as raw cells and are parsed after their last shuffle, that of their identity, so
    no shuffle carries parsed columns and every cell is parsed once.
    """
    hot = hot_keys(raw, spec, config)
    value = lambda name: field_value(spec, name, config)
    rows = with_parent_flags(raw, spec, parents, value, settle)
    if spec.name == "returns":
        rows = with_purchase(rows, parents, value)
    if "ragged" not in rows.columns:
        rows = rows.withColumn("ragged", F.lit(False))

    # Only a conflict of keys is not known of a row alone.
    sql = config.dialect == SQL_DIALECT
    text = first_reason if sql else reason_text
    findings = sql_findings(spec, config) if sql else row_findings(spec, config)
    at = next(i for i, x in enumerate(findings) if x.message.endswith(SQL_CONFLICT_REASON if sql else CONFLICT_REASON))
    kept = ["source_row", "_raw", *spec.columns, *(["_bought"] if spec.name == "returns" else [])]

    def judge(_: DataFrame) -> list:
        return [*kept, text(findings[:at]).alias("_before"), text(findings[at + 1 :]).alias("_after")]

    rows = read_identified(rows, spec, config, hot, judge)
    both = [Finding(F.col("_before") != "", F.col("_before")), findings[at], Finding(F.col("_after") != "", F.col("_after"))]
    rows = rows.withColumn("_reasons", text(both)).drop("_before", "_after")
    if spec.name == "returns":
        if settle:
            rows = settle("checked_returns", rows.drop("_key_conflict"))
        rows = with_cumulative_bound(rows, config, settle)
    return label(rows, spec, config)


def with_parent_flags(
    rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], value: Callable[[str], Column] = F.col, settle=None
) -> DataFrame:
    """One boolean ``_has_<table>`` per parent. Parent keys are unique, so rows never multiply (a parent that
    is there twice gives its rows twice); the join carries no hint, so Spark broadcasts by measured size and
    splits skewed shuffle partitions. ``value`` reads a column of rows that are not parsed yet.

    With ``settle``, the different keys without just one parent are found first and stored, and rows meet those:
    where they are few, Spark broadcasts them and no row is shuffled."""
    given = rows
    for parent in spec.parents:
        flag = f"_has_{parent.table}"
        keys = parents[parent.table].select(F.col(parent.column).alias("_p"))
        rows = rows.withColumn("_k", value(parent.column))
        if settle:
            held = keys.groupBy("_p").agg(F.count(F.lit(1)).cast("int").alias("_n"))
            found = F.coalesce("_n", F.lit(0))
            others = given.select(value(parent.column).alias("_p")).distinct().join(held, "_p", "left")
            others = settle(f"orphans_{parent.table}", others.filter(found != 1).select("_p", found.alias("_n")))
            times = F.when(F.col("_k").isNotNull(), F.coalesce("_n", F.lit(1))).otherwise(0)
            rows = rows.join(others, F.col("_k") == F.col("_p"), "left").withColumn(flag, times > 0)
            if not others.filter(F.col("_n") > 1).isEmpty():
                rows = rows.withColumn("_n", F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(1)))))
            rows = rows.drop("_n")
        else:
            rows = rows.join(keys, F.col("_k") == F.col("_p"), "left").withColumn(flag, F.col("_p").isNotNull())
        rows = rows.drop("_k", "_p")
    return rows


def with_purchase(events: DataFrame, parents: Mapping[str, DataFrame], value: Callable[[str], Column] = F.col) -> DataFrame:
    """Attach the purchased quantity, order status and order date of the accepted line, if any."""
    orders = parents["orders"].select(
        F.col("order_id").alias("_o"), F.col("status").alias("_status"), F.col("order_date").alias("_ordered")
    )
    lines = parents["order_lines"].select(
        F.col("order_line_id").alias("_l"), F.col("order_id").alias("_lo"), F.col("quantity").alias("_bought")
    )
    purchases = lines.join(orders, F.col("_lo") == F.col("_o")).drop("_lo", "_o")
    return events.withColumn("_k", value("order_line_id")).join(purchases, F.col("_k") == F.col("_l"), "left").drop("_k")


def row_findings(spec: TableSpec, config: RunConfig) -> list[Finding]:
    """Field reasons, then key conflict, then parents, then the return rules."""
    found = [Finding(F.col("ragged"), RAGGED_REASON), *field_findings(spec, config)]
    found.append(Finding(F.col("_key_conflict"), f"{spec.key}: {CONFLICT_REASON}"))
    for parent in spec.parents:
        unknown = ~F.col(f"_has_{parent.table}")
        found.append(Finding(unknown, f"{parent.column}: {PARENT_REASON} {parent.noun}"))
    if spec.name == "returns":
        found += return_findings(config)
    return found


def return_findings(config: RunConfig) -> list[Finding]:
    """Rules that need the purchase; a missing line silences the others."""
    known = F.col("_l").isNotNull()
    day, cutoff = F.col("return_date"), config.return_cutoff
    return [
        Finding(~known, UNKNOWN_LINE_REASON),
        Finding(known & (F.col("_status") != config.sale_status), NOT_COMPLETED_REASON),
        Finding(known & (day < F.col("_ordered")), TOO_EARLY_REASON),
        Finding(known & (day > F.lit(cutoff)), TOO_LATE_REASON.format(cutoff=cutoff.isoformat())),
        Finding(
            known & (F.col("return_quantity") > F.col("_bought")),
            TOO_MANY_REASON,
        ),
    ]


def with_cumulative_bound(events: DataFrame, config: RunConfig, settle=None) -> DataFrame:
    """Reject all otherwise valid events of a line whose units together exceed the purchase.

    Individually bad events and copies neither count nor suffer. Events meet only the lines that exceed, which
    ``settle`` stores, so that few of them are broadcast instead of all events being shuffled."""
    valid = ~F.col("_copy") & (F.col("_reasons") == "")
    units = F.sum(F.col("return_quantity").cast("bigint"))
    per_line = events.filter(valid).groupBy(F.col("order_line_id").alias("_over")).agg(units.alias("_units"), F.min("_bought").alias("_least"))
    over = per_line.filter(F.col("_units") > F.col("_least")).select("_over", "_units")
    if settle:
        over = settle("exceeded_lines", over)
    bounded = events.join(over, F.col("order_line_id").eqNullSafe(F.col("_over")), "left").drop("_over")
    message = SQL_CUMULATIVE_REASON if config.dialect == SQL_DIALECT else CUMULATIVE_REASON
    exceeded = F.coalesce(valid & (F.col("_units") > F.col("_bought")), F.lit(False))
    return bounded.withColumn(
        "_reasons", F.when(exceeded, F.lit(message)).otherwise(F.col("_reasons"))
    )


def label(rows: DataFrame, spec: TableSpec, config: RunConfig) -> DataFrame:
    """Audit columns, the untouched cells (``raw``) and the typed columns."""
    copy_reason = SQL_COPY_REASON if config.dialect == SQL_DIALECT else COPY_REASON
    disposition = (
        F.when(F.col("_copy"), DUPLICATE).when(F.col("_reasons") != "", REJECTED).otherwise(ACCEPTED)
    )
    reason = F.when(F.col("_copy"), F.lit(copy_reason)).otherwise(F.nullif("_reasons", F.lit("")))
    return rows.select(
        F.lit(spec.name).alias("source_table"),
        "source_row",
        "business_key",
        disposition.alias("disposition"),
        reason.alias("rejection_reason"),
        F.when(F.col("_copy"), F.col("retained_source_row")).alias("retained_source_row"),
        F.col("_raw").alias("raw"),
        *spec.columns,
    )


def sql_findings(spec: TableSpec, config: RunConfig) -> list[Finding]:
    """The SQL dialect: conflicts leave first, then one reason per row in a fixed order per table."""

    def bad_key() -> Finding:
        limit = spec.field(spec.key).length
        key = F.col(spec.key)
        return Finding((key == "") | longer_than(key, limit), SQL_BAD_KEY.format(spec.key_noun))

    def bad_text(name: str, noun: str) -> Finding:
        value = F.col(name)
        long = longer_than(value, spec.field(name).max_length)
        return Finding((value == "") | long, SQL_BAD_TEXT.format(noun))

    def unknown(name: str, noun: str) -> Finding:
        return Finding(F.col(name).isNull(), SQL_UNKNOWN_WORD.format(noun))

    def orphan(parent: str, noun: str) -> Finding:
        return Finding(~F.col(f"_has_{parent}"), SQL_ORPHAN.format(noun))

    def price(name: str, noun: str) -> list[Finding]:
        number = F.col(f"_n_{name}")
        return [
            Finding(number.isNull() | (number <= 0), SQL_BAD_PRICE.format(noun)),
            Finding(~numbers.fits(number, numbers.MONEY), SQL_TOO_PRECISE.format(noun)),
        ]

    def count(name: str, noun: str) -> Finding:
        return Finding(F.col(name).isNull(), SQL_BAD_COUNT.format(noun))

    found = [
        Finding(F.col("ragged"), RAGGED_REASON),
        Finding(F.col("_key_conflict"), SQL_CONFLICT_REASON),
        bad_key(),
    ]
    if spec.name == "customers":
        found += [bad_text("customer_name", "customer name"), unknown("region", "region"), unknown("segment", "segment")]
    elif spec.name == "products":
        found += [bad_text("product_name", "product name"), bad_text("category", "category")]
        found += price("list_price", "List price")
    elif spec.name == "orders":
        day = F.col("order_date")
        inside = (day >= F.lit(config.order_from)) & (day < F.lit(config.order_before))
        found += [
            Finding(day.isNull(), SQL_BAD_DATE.format("order")),
            Finding(~inside, SQL_OUTSIDE_WINDOW.format(config.window_label)),
            orphan("customers", "customer"),
            unknown("channel", "channel"),
            unknown("status", "order status"),
        ]
    elif spec.name == "order_lines":
        rate = F.col("_n_discount_rate")
        found += [orphan("orders", "order"), orphan("products", "product"), count("quantity", "Quantity")]
        found += price("unit_price", "Unit price")
        found += [
            Finding(rate.isNull() | ~rate.between(0, 1), SQL_BAD_RATE),
            Finding(~numbers.fits(rate, numbers.RATE), SQL_TOO_PRECISE.format("Discount")),
        ]
    else:
        day, cutoff = F.col("return_date"), config.return_cutoff
        found += [
            Finding(F.col("_l").isNull(), SQL_ORPHAN.format("order line")),
            Finding(F.col("_status") != config.sale_status, SQL_NOT_COMPLETED),
            Finding(day.isNull(), SQL_BAD_DATE.format("return")),
            Finding(day < F.col("_ordered"), SQL_TOO_EARLY),
            Finding(day > F.lit(cutoff), SQL_TOO_LATE.format(cutoff.isoformat())),
            count("return_quantity", "Return quantity"),
            Finding(
                F.col("return_quantity") > F.col("_bought"), SQL_TOO_MANY
            ),
            bad_text("reason", "return reason"),
        ]
    return found


def accepted(labelled: DataFrame, spec: TableSpec) -> DataFrame:
    return labelled.filter(F.col("disposition") == ACCEPTED).select(*spec.columns, "source_row")


class Cleaning(Mapping):
    """The labelled tables, each cleaned when it is first asked for, parents before children.

    ``settle(name, labelled)`` may write a labelled table and return the stored copy, so that children
    read accepted parents from storage instead of recomputing them.
    """

    def __init__(self, raw: Mapping[str, DataFrame], config: RunConfig, settle=None):
        self._raw, self._config, self._settle = raw, config, settle
        self._labelled: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._labelled:
            spec = self._config.table(name)
            above = ["orders", "order_lines"] if name == "returns" else [p.table for p in spec.parents]
            parents = {n: accepted(self[n], self._config.table(n)) for n in above}
            frame = clean_table(self._raw[name], spec, parents, self._config, self._settle)
            self._labelled[name] = self._settle(name, frame) if self._settle else frame
        return self._labelled[name]

    def __iter__(self) -> Iterator[str]:
        return (t.name for t in self._config.tables)

    def __len__(self) -> int:
        return len(self._config.tables)


def clean_all(raw: Mapping[str, DataFrame], config: RunConfig, settle=None) -> dict[str, DataFrame]:
    """Label all tables, parents before children."""
    return dict(Cleaning(raw, config, settle))

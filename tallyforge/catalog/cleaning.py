"""Cleaning operators over the dirty text view of the lake."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CANONICAL, SQL_DIALECT
from ..operators import audit
from ..operators.clean import REJECTED, Cleaning, accepted, clean_all, return_findings, with_parent_flags, with_purchase
from ..operators.identity import with_identity
from ..operators.normalize import collect_reasons, normalize, read_fields
from ..session import settler, shared_dir, shuffles_removed
from ..sources.lake import CUSTOMER_ID, raw_tables
from ..sources.observed import write_counted
from . import cleaning_sql as plain
from .base import query

CONFIG = plain.CONFIG


_STORED: dict[tuple, Mapping[str, DataFrame]] = {}
_VIEWS: dict[tuple, Mapping[str, DataFrame]] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and time of every file the dirty view reads; contents are not read."""
    tables = ("region", "nation", "customer", "part", "orders", "lineitem")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f"{sf_dir}/{t}.parquet" for t in tables])
    return tuple(sorted(tuple(r) for r in files.select("path", "length", F.col("modificationTime").cast("string")).collect()))


def _labelled(spark: SparkSession, sf_dir: str, dialect: str) -> Mapping[str, DataFrame]:
    """The labelled tables, each cleaned and stored when a report first reads it. Reports of one session over
    the same files read one stored result; changed or further files are cleaned again."""
    key = (spark.sparkContext.applicationId, sf_dir, dialect, _state(spark, sf_dir))
    if key not in _STORED:
        if len(_STORED) >= 8:
            _STORED.clear()
        _STORED[key] = Cleaning(_sources(spark, sf_dir), CONFIG.with_(dialect=dialect), settler(spark))
    return _STORED[key]


def _sources(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The dirty view. Its lines are numbered once for all reports of one session over the same files."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    if key not in _VIEWS:
        if len(_VIEWS) >= 8:
            _VIEWS.clear()
        _VIEWS[key] = raw_tables(spark, sf_dir)
    return _VIEWS[key]


def forget() -> None:
    """Drop the stored views and cleaning results, so that the next report cleans again."""
    _STORED.clear()
    _VIEWS.clear()


def _log(spark: SparkSession, sf_dir: str, dialect: str) -> DataFrame:
    return audit.disposition_log(_labelled(spark, sf_dir, dialect))


def _texts(log: DataFrame) -> DataFrame:
    """Row numbers as text, after whatever has sorted them."""
    return log.withColumns({c: F.col(c).cast("string") for c in ("source_row", "retained_source_row") if c in log.columns})


# ------------------------------------------------------------------ one table at a time


def _normalize_query(name: str) -> None:
    table = CONFIG.table(name)
    columns = ", ".join(table.columns)
    sql = f"WITH {plain.normalized(table)} SELECT CAST(source_row AS VARCHAR) AS source_row, {columns}, field_reasons AS reasons FROM n_{name}"

    @query(f"normalize_{name}", sql)
    def build(spark, sf_dir):
        frame = normalize(_sources(spark, sf_dir)[name], table, CONFIG)
        return frame.withColumns({"source_row": F.col("source_row").cast("string"), "reasons": F.array_join("reasons", "; ")})


for _table in CONFIG.tables:
    _normalize_query(_table.name)


def _identity(spark: SparkSession, sf_dir: str, name: str, dialect: str) -> DataFrame:
    config = CONFIG.with_(dialect=dialect)
    table = config.table(name)
    return with_identity(read_fields(_sources(spark, sf_dir)[name], table, config), table, config)


def _dedupe_sql(name: str, sql: bool) -> str:
    return (
        f"WITH {plain.identified(CONFIG.table(name), sql)} SELECT CAST(source_row AS VARCHAR) AS source_row,"
        f" nullif({CONFIG.table(name).key}, '') AS business_key, CAST(retained AS VARCHAR) AS retained_source_row, rn > 1 AS is_copy FROM i_{name}"
    )


def _dedupe(spark, sf_dir, name, dialect):
    return _identity(spark, sf_dir, name, dialect).select(
        F.col("source_row").cast("string").alias("source_row"),
        "business_key",
        F.col("retained_source_row").cast("string").alias("retained_source_row"),
        F.col("_copy").alias("is_copy"),
    )


@query("dedupe_exact", _dedupe_sql("order_lines", False))
def dedupe_exact(spark, sf_dir):
    """Copies of order lines, compared by value: 211.00 and $211.0 are the same price."""
    return _dedupe(spark, sf_dir, "order_lines", CANONICAL)


@query("dedupe_raw", _dedupe_sql("customers", True))
def dedupe_raw(spark, sf_dir):
    """Copies of customers, compared by untouched cells."""
    return _dedupe(spark, sf_dir, "customers", SQL_DIALECT)


@query("key_conflicts", f"WITH {plain.identified(CONFIG.table('order_lines'))}"
       " SELECT order_line_id AS business_key, count(*) AS conflicting_records FROM i_order_lines WHERE conflict AND rn = 1 GROUP BY order_line_id")
def key_conflicts(spark, sf_dir):
    """Keys carried by more than one distinct record."""
    rows = _identity(spark, sf_dir, "order_lines", CANONICAL).filter(F.col("_key_conflict") & ~F.col("_copy"))
    return rows.groupBy("business_key").agg(F.count(F.lit(1)).alias("conflicting_records"))


# ------------------------------------------------------------------ across tables


@query("fk_rejects", f"WITH {plain.chain(upto='order_lines')} SELECT CAST(source_row AS VARCHAR) AS source_row,"
       " has_orders AS known_order, has_products AS known_product FROM l_order_lines")
def fk_rejects(spark, sf_dir):
    """Order lines against the accepted orders and products."""
    table = CONFIG.table("order_lines")
    frames = _labelled(spark, sf_dir, CANONICAL)
    parents = {p.table: accepted(frames[p.table], CONFIG.table(p.table)) for p in table.parents}
    parsed = read_fields(_sources(spark, sf_dir)["order_lines"], table, CONFIG)
    return with_parent_flags(parsed, table, parents).select(
        F.col("source_row").cast("string").alias("source_row"),
        F.col("_has_orders").alias("known_order"),
        F.col("_has_products").alias("known_product"),
    )


@query("return_rules", f"WITH {plain.chain()} SELECT CAST(source_row AS VARCHAR) AS source_row, concat_ws('; ',"
       " CASE WHEN bought IS NULL THEN 'order_line_id: unknown or rejected line' END,"
       " CASE WHEN order_status <> 'Completed' THEN 'order_id: return requires completed order' END,"
       " CASE WHEN return_date < ordered THEN 'return_date: precedes order date' END,"
       f" CASE WHEN bought IS NOT NULL AND return_date > DATE '{CONFIG.return_cutoff}' THEN 'return_date: after {CONFIG.return_cutoff} cutoff' END,"
       " CASE WHEN return_quantity > bought THEN 'return_quantity: event exceeds purchased quantity' END) AS broken_rules FROM l_returns")
def return_rules(spark, sf_dir):
    """Each return event against its purchase: status, dates and quantity."""
    table = CONFIG.table("returns")
    frames = _labelled(spark, sf_dir, CANONICAL)
    parents = {n: accepted(frames[n], CONFIG.table(n)) for n in ("orders", "order_lines")}
    events = with_purchase(read_fields(_sources(spark, sf_dir)["returns"], table, CONFIG), parents)
    broken = F.array_join(collect_reasons(return_findings(CONFIG)), "; ")
    return events.select(F.col("source_row").cast("string").alias("source_row"), broken.alias("broken_rules"))


@query("return_cumulative", f"WITH {plain.chain()} SELECT order_line_id, count(*) AS events, CAST(sum(return_quantity) AS BIGINT) AS units,"
       " max(bought) AS purchased FROM l_returns WHERE final_reason LIKE '%cumulative%' GROUP BY order_line_id")
def return_cumulative(spark, sf_dir):
    """Lines whose otherwise valid events together exceed the purchase."""
    frames = _labelled(spark, sf_dir, CANONICAL)
    over = frames["returns"].filter(F.col("rejection_reason").contains("cumulative"))
    lines = accepted(frames["order_lines"], CONFIG.table("order_lines")).select("order_line_id", F.col("quantity").alias("purchased"))
    folded = over.groupBy("order_line_id").agg(F.count(F.lit(1)).alias("events"), F.sum("return_quantity").alias("units"))
    return folded.join(lines, "order_line_id")


@query("disposition", f"{plain.log()} SELECT * FROM log")
def disposition(spark, sf_dir):
    """Every raw row of every table with exactly one disposition, all reasons and its JSON."""
    return _texts(_log(spark, sf_dir, CANONICAL))


@query("disposition_first_reason", f"{plain.log(True)} SELECT * FROM log")
def disposition_first_reason(spark, sf_dir):
    """The SQL dialect: raw-text copies, conflicts first, one reason per row."""
    return _texts(_log(spark, sf_dir, SQL_DIALECT))


_QUALITY = (
    " SELECT source_table AS \"table\", count(*) AS raw_rows, count(*) FILTER (disposition = 'Duplicate') AS duplicate_rows_removed,"
    " count(*) FILTER (disposition = 'Rejected') AS rejected_rows, count(*) FILTER (disposition = 'Accepted') AS clean_rows,"
    " count(*) = count(*) FILTER (disposition IN ('Duplicate', 'Rejected', 'Accepted')) AS accounting_passed FROM log GROUP BY source_table"
)


@query("quality_summary", plain.log() + _QUALITY)
def quality_summary(spark, sf_dir):
    return audit.quality_summary(_labelled(spark, sf_dir, CANONICAL))


@query("observed_quality", plain.log() + _QUALITY)
def observed_quality(spark, sf_dir):
    """The quality summary as the writes of the labelled tables counted it."""
    counts: dict[str, dict[str, int]] = {}

    def settle(name: str, frame: DataFrame) -> DataFrame:
        path = shared_dir(spark, name)
        tallies = audit.disposition_tallies() if "disposition" in frame.columns else {}
        with shuffles_removed(spark):
            seen = write_counted(frame, path, tallies)
        if tallies:
            counts[name] = seen
        return spark.read.schema(frame.schema).parquet(path)

    clean_all(_sources(spark, sf_dir), CONFIG, settle)
    return audit.observed_quality(spark, counts)


@query("quality_summary_sql_dialect", plain.log(True) + _QUALITY)
def quality_summary_sql_dialect(spark, sf_dir):
    return audit.quality_summary(_labelled(spark, sf_dir, SQL_DIALECT))


@query("duplicate_evidence", f"{plain.log(True)} SELECT source_table, business_key, source_row, retained_source_row, raw_json FROM log WHERE disposition = 'Duplicate'")
def duplicate_evidence(spark, sf_dir):
    """Raw-text copies with the row that was kept."""
    return _texts(audit.listing(_log(spark, sf_dir, SQL_DIALECT), "Duplicate").select(
        "source_table", "business_key", "source_row", "retained_source_row", "raw_json"
    ))


@query("rejected_listing", f"{plain.log()} SELECT source_table, source_row, business_key, reason, raw_json FROM log WHERE disposition = 'Rejected'")
def rejected_listing(spark, sf_dir):
    return _texts(audit.listing(_log(spark, sf_dir, CANONICAL), REJECTED).select(
        "source_table", "source_row", "business_key", "reason", "raw_json"
    ))


def _profile_sql(name: str) -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM raw" for c in CONFIG.table(name).columns)
    return (
        f"SELECT '{name}' AS \"table\", \"column\", count(*) AS rows, count(*) FILTER (value IS NULL OR trim(value) = '') AS empty,"
        " count(*) FILTER (value <> trim(value)) AS padded, count(DISTINCT value) AS distinct_values, min(value) AS smallest, max(value) AS largest"
        f" FROM (WITH raw AS ({plain.RAW_SQL[name]}) {cells}) c GROUP BY \"column\""
    )


@query("column_profile", " UNION ALL ".join(_profile_sql(n) for n in plain.RAW_SQL))
def column_profile(spark, sf_dir):
    """Whole-table column profile before cleaning."""
    raw = _sources(spark, sf_dir)
    return audit.union_all([audit.profile(raw[n], n, CONFIG.table(n).columns) for n in plain.RAW_SQL])


@query("named_rows", f"{plain.log()} SELECT source_table, disposition, count(*) AS rows FROM log WHERE business_key IN"
       " (SELECT 'C' || CASE WHEN c_custkey < 1000000000000 THEN lpad(CAST(c_custkey AS VARCHAR), 12, '0') ELSE CAST(c_custkey AS VARCHAR) END FROM customer WHERE c_acctbal < 0) GROUP BY ALL")
def named_rows(spark, sf_dir):
    """Dispositions of a given list of keys: the customers with a negative balance."""
    listed = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_acctbal < 0")
    keys = listed.select(F.expr(CUSTOMER_ID).alias("business_key"))
    return audit.sentinels(_log(spark, sf_dir, CANONICAL), keys)

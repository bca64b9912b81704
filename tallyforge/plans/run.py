"""The batch run: a folder of CSV deliveries in, cleaned tables, evidence, summaries and checks out.

Every stage is written before the next one reads it: parents are cleaned once however many children
refer to them, and a lost executor costs a re-read. Rows are counted by the writes themselves. All outputs
are overwritten, raw files are only read, so a second run over the same input gives the same result;
``reload`` gives every run a folder of its own and makes it current only when all of it is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RETAIL_2025, RunConfig
from ..operators import audit
from ..operators.clean import accepted, clean_all
from ..operators.compare import expected_vs_actual
from ..session import FACT_SETTINGS, tune
from ..sources import csv, files, versions
from ..sources.observed import write_counted
from . import checks, reports
from .model import line_facts, prepared, register_views


@dataclass(frozen=True)
class RunResult:
    labelled: Mapping[str, DataFrame]
    model: Mapping[str, DataFrame]
    quality: DataFrame
    checks: DataFrame


SUMMARIES = {
    "order_summary": reports.order_summary,
    "monthly_summary": reports.monthly,
    "category_summary": reports.category_summary,
    "product_summary": reports.product_summary_ranked,
    "channel_summary": reports.channel_summary,
    "region_summary": reports.region_summary,
    "customer_summary": reports.customer_summary,
}


def run(
    spark: SparkSession,
    raw_folder: str,
    out_folder: str,
    config: RunConfig = RETAIL_2025,
    *,
    expectations: str | None = None,
    quoted_newlines: bool = True,
    csv_outputs: bool = True,
) -> RunResult:
    """Clean, model, measure, reconcile and write. Raises ``ValidationError`` naming failed checks,
    after all outputs are in place."""
    if raw_folder.rstrip("/") == out_folder.rstrip("/"):
        raise ValueError("the output folder must differ from the raw folder")
    tune(spark, FACT_SETTINGS)
    raw = csv.read_tables(spark, raw_folder, config, quoted_newlines=quoted_newlines)
    staged_rows: dict[str, int] = {}
    staged = csv.stage(raw, f"{out_folder}/staged", spark, staged_rows)
    guard = _stored(spark, checks.staging_checks(audit.staging_guard(staged, config)), f"{out_folder}/checks/staging")
    checks.enforce(guard)
    counts: dict[str, dict[str, int]] = {}
    labelled = clean_all(staged, config, _store(spark, out_folder, counts))
    model = {t.name: accepted(labelled[t.name], t) for t in config.tables}

    quality = _stored(spark, audit.observed_quality(spark, counts), f"{out_folder}/analysis/quality_summary")
    if csv_outputs:
        write_evidence(labelled, out_folder, config)
    write_facts(spark, model, out_folder, config)
    model = prepared(model, config, lambda name, frame: _stored(spark, frame, f"{out_folder}/facts/{name}"))
    for name, build in SUMMARIES.items():
        build(model, config).write.mode("overwrite").parquet(f"{out_folder}/analysis/{name}")
    register_views(spark, model, config, quality)

    results = checks.all_checks(model, config, quality).unionByName(checks.rule_checks(model, config)).unionByName(guard)
    results = results.unionByName(checks.staged_all_labelled(spark, staged_rows, quality))
    if expectations:
        expected = files.read_expectations(spark, expectations, config)
        compared = expected_vs_actual(expected, checks.actual_measures(model, config, quality))
        results = results.unionByName(checks.expectation_checks(compared))
    results = _stored(spark, results, f"{out_folder}/checks/validation_results")
    manifest = _stored(spark, files.source_manifest(spark, raw_folder, staged, config), f"{out_folder}/checks/manifest")
    files.write_json(manifest, f"{out_folder}/checks/source_manifest")
    passed = results.agg(F.every("passed").alias("validation_passed"))
    summary = reports.business_summary(model, config, quality, sources=manifest, passed=passed)
    files.write_json(summary, f"{out_folder}/analysis/summary")
    checks.enforce(results)
    return RunResult(labelled, model, quality, results)


def reload(spark: SparkSession, raw_folder: str, root: str, config: RunConfig = RETAIL_2025, *, force: bool = False, **options) -> versions.Version:
    """``run`` into a new version under ``root``, committed as the current one once all its outputs are
    written and all its checks have passed. Until then, and if it dies or fails, the version before stays
    whole and current. An input that the current version was loaded from, with equal settings, is not
    loaded again unless ``force`` is set.
    """
    if raw_folder.rstrip("/") == root.rstrip("/"):
        raise ValueError("the output folder must differ from the raw folder")
    tune(spark, FACT_SETTINGS)
    fingerprint = _fingerprint(spark, raw_folder, config, options)
    before = versions.current(spark, root)
    if before and before.fingerprint == fingerprint and not force:
        return before
    folder = versions.begin()
    result = run(spark, raw_folder, f"{root}/{folder}", config, **options)
    rows = {r["table"]: r["raw_rows"] for r in result.quality.select("table", "raw_rows").collect()}
    return versions.commit(spark, root, folder, fingerprint=fingerprint, rows=rows)


def _fingerprint(spark: SparkSession, raw_folder: str, config: RunConfig, options: Mapping[str, object]) -> str:
    """Digest of the delivered files, the expectations and the settings. Files add up in any order, so their
    number does not matter."""
    paths = [f"{raw_folder}/{t.name}.csv" for t in config.tables] + ([str(options["expectations"])] if options.get("expectations") else [])
    found = reduce(DataFrame.unionByName, [files.file_digests(spark, path) for path in paths])
    name = F.sha2(F.concat_ws(":", "path", "sha256", F.col("bytes").cast("string")), 256)
    pieces = [F.sum(F.conv(F.substring(name, at, 15), 16, 10).cast("decimal(38,0)")).alias(f"p{at}") for at in (1, 16, 31, 46)]
    sums = found.agg(F.count(F.lit(1)).alias("files"), *pieces).first()
    settings = [repr(config), *(f"{k}={v}" for k, v in sorted(options.items()))]
    return hashlib.sha256("|".join([*map(str, sums), *settings]).encode()).hexdigest()


def _store(spark: SparkSession, out_folder: str, counts: dict[str, dict[str, int]]):
    """Labelled tables are partitioned by disposition, so children read accepted rows only; their writes
    count the dispositions."""

    def settle(name: str, frame: DataFrame) -> DataFrame:
        path = f"{out_folder}/labelled/{name}"
        if "disposition" in frame.columns:
            counts[name] = write_counted(frame, path, audit.disposition_tallies(), partition_by=["disposition"])
        else:
            frame.write.mode("overwrite").parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    return settle


def _stored(spark: SparkSession, frame: DataFrame, path: str) -> DataFrame:
    frame.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_evidence(labelled: Mapping[str, DataFrame], out_folder: str, config: RunConfig) -> None:
    """Clean, rejected and duplicate rows as CSV with fixed headers, also where nothing was found."""
    for t in config.tables:
        csv.write_csv(accepted(labelled[t.name], t), f"{out_folder}/clean/{t.name}.csv")
        csv.write_csv(audit.rejected_rows(labelled[t.name], t), f"{out_folder}/rejected/{t.name}.csv")
        csv.write_csv(audit.duplicate_rows(labelled[t.name], t), f"{out_folder}/rejected/duplicates_{t.name}.csv")


def write_facts(spark: SparkSession, model: Mapping[str, DataFrame], out_folder: str, config: RunConfig) -> None:
    facts = _stored(spark, line_facts(model, config, by_line=False), f"{out_folder}/analysis/fact_order_lines")
    sales = facts.filter(F.col("include_in_sales_kpi"))
    sales.write.mode("overwrite").parquet(f"{out_folder}/analysis/sales_fact_completed")

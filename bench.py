"""Times the headline queries and prints one JSON line.

Each query is built and written to a no-op sink: once to warm up, then BENCH_RUNS times (median).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINES = [
    "line_sales", "order_sales", "annual_kpis", "order_summary", "category_contribution", "product_summary_ranked",
    "top3_products_per_category", "top10_products_by_refund", "channel_summary", "region_summary", "customer_summary",
    "repeat_customers", "monthly_trend", "returning_at_purchase", "order_sequence", "refund_by_reason", "what_if",
    "normalize_orders", "normalize_order_lines", "dedupe_exact", "disposition", "constraint_violations", "reconcile_summaries",
    "findings_extremes", "group_vs_overall", "json_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINES

    from pyspark.sql import SparkSession

    from tallyforge.catalog import QUERIES, cleaning
    from tallyforge.session import SETTINGS

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        cleaning.forget()
        start = time.perf_counter()
        QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total headline query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

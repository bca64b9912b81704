"""Settings of the registered queries."""

from pyspark.sql import functions as F

from tallyforge.catalog.base import QUERIES, query


def test_tasks_of_facts_do_not_grow_with_few_shuffle_partitions(spark):
    try:
        query("cut", None)(lambda spark, path: spark.range(9).groupBy(F.col("id") % 5).count())
        plan = QUERIES["cut"].build(spark, "")._jdf.queryExecution().executedPlan().toString()
    finally:
        QUERIES.pop("cut", None)
    assert ", 800)" in plan and ", 4)" not in plan

"""Facts that are stored whole: the order of their joins."""

import pytest

from tables import CONFIG, parents
from tallyforge.plans import model as facts


@pytest.fixture
def unbroadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString().splitlines()


def test_stored_facts_shuffle_lines_before_they_are_wide(spark, unbroadcast):
    model = {**parents(spark), "returns": spark.createDataFrame(
        [("R1", "L640219", None, 1, "x")], "return_id STRING, order_line_id STRING, return_date DATE, return_quantity INT, reason STRING")}
    wide, by_line = (facts.line_facts(model, CONFIG, by_line=b) for b in (False, True))
    assert wide.columns == by_line.columns and wide.collect() == by_line.collect() and wide.count() == 1

    def depth(key):
        return max(line.index("Exchange") for line in plan(wide) if f"Exchange hashpartitioning({key}#" in line)

    assert depth("order_line_id") > depth("product_id") > depth("order_id")

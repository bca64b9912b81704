"""Set and dataset comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Child rows whose key has no parent. An anti join, so NULL keys count as missing."""
    keys = parent.select(F.col(parent_column or column).alias("_parent_key"))
    return child.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def key_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two counts: keys only on the left, keys only on the right. Both zero means equal sets."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    sides = a.withColumn("_l", F.lit(1)).join(b.withColumn("_r", F.lit(1)), key, "full_outer")
    return sides.agg(
        F.count_if(F.col("_r").isNull()).alias("only_left"), F.count_if(F.col("_l").isNull()).alias("only_right")
    )


def dataset_diff(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    normalise: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Compare two tables with unique keys field by field, one row per column.

    ``normalise`` maps a column name to an expression over that name, applied to both sides before they
    are compared; the plain mismatches are reported next to the normalised ones.
    """
    rules = dict(normalise or {})

    def side(frame: DataFrame, mark: str) -> DataFrame:
        plain = [F.col(c).alias(f"{mark}_{c}") for c in columns]
        adapted = [rules.get(c, F.col(c)).alias(f"{mark}n_{c}") for c in columns]
        return frame.select(F.col(key).alias(f"{mark}_key"), *plain, *adapted)

    both = side(left, "l").join(side(right, "r"), F.col("l_key").eqNullSafe(F.col("r_key")), "full_outer")
    matched = F.col("l_key").isNotNull() & F.col("r_key").isNotNull()
    counts = [
        F.count_if(F.col("r_key").isNull()).alias("only_left"),
        F.count_if(F.col("l_key").isNull()).alias("only_right"),
    ]
    for c in columns:
        counts.append(F.count_if(matched & ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))).alias(f"p_{c}"))
        counts.append(F.count_if(matched & ~F.col(f"ln_{c}").eqNullSafe(F.col(f"rn_{c}"))).alias(f"n_{c}"))
    totals = both.agg(*counts)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"p_{c}").alias("mismatches"), F.col(f"n_{c}").alias("normalised_mismatches"))
            for c in columns
        ]
    )
    return totals.select("only_left", "only_right", F.explode(cells).alias("cell")).select(
        "cell.*", "only_left", "only_right"
    )


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Whole-row comparison with multiplicities: rows on one side only, with their surplus."""
    columns = left.columns
    tagged = left.withColumn("_n", F.lit(1)).unionByName(right.select(*columns).withColumn("_n", F.lit(-1)))
    return tagged.groupBy(*columns).agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)


def expected_vs_actual(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer comparison of (measure, expected) with (measure, actual) as exact decimals."""
    joined = expected.withColumnRenamed("measure", "_e").join(
        actual.withColumnRenamed("measure", "_a"), F.col("_e") == F.col("_a"), "full_outer"
    )
    same = F.coalesce(
        F.col("expected").try_cast("decimal(38,10)") == F.col("actual").try_cast("decimal(38,10)"), F.lit(False)
    )
    return joined.select(F.coalesce("_e", "_a").alias("measure"), "expected", "actual", same.alias("passed"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

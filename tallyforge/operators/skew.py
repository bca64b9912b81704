"""Group statistics without windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_stats(rows: DataFrame, on: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Give every row aggregates of its group: the work of an unordered window, without handing any group
    to a single task. Partial aggregation shrinks hot groups before the shuffle, and the join back has one
    row a group on its right, so Spark broadcasts that side where it is small and splits skewed
    partitions of the left side where it is not (see ``session.SETTINGS``)."""
    keys = [F.col(c).alias(f"_on_{c}") for c in on]
    grouped = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    same = F.lit(True)
    for c in on:
        same = same & rows[c].eqNullSafe(grouped[f"_on_{c}"])
    return rows.join(grouped, same, "left").drop(*[f"_on_{c}" for c in on])

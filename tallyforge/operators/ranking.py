"""Ranks and sequences over data too large for one sorted task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scan import number_in_groups, number_values


def global_dense_rank(rows: DataFrame, value: str, name: str, slices: int | None = None) -> DataFrame:
    """Dense rank of ``value``, largest first, over the whole frame: the number of its distinct value in a
    sample sort (``number_values``, in ``slices`` ranges or as many as the data need). Missing values share
    the last rank."""
    values = rows.select(F.col(value).alias("_value")).distinct()
    ranked = number_values(values, [F.desc("_value")], name, slices)
    return rows.join(ranked, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")


def top_values(rows: DataFrame, value: str, count: int, name: str) -> DataFrame:
    """Rows holding one of the ``count`` largest distinct values, ties kept, with their dense rank.

    The ranked values are a top-k of distinct values, so at most ``count`` rows are broadcast."""
    best = rows.select(F.col(value).alias("_value")).distinct().orderBy(F.desc("_value")).limit(count)
    ranked = best.withColumn(name, F.dense_rank().over(W.orderBy(F.desc("_value"))))
    return rows.join(F.broadcast(ranked), F.col(value) == F.col("_value")).drop("_value")


def top_per_group(rows: DataFrame, group: str, value: str, count: int, name: str) -> DataFrame:
    """Per group, rows holding one of the ``count`` largest distinct values, ties kept.

    Ranking runs over distinct (group, value) pairs, where a row-number limit is applied before the
    shuffle; rows that tie on a value come back by join and may be many without passing one window."""
    pairs = rows.select(F.col(group).alias("_group"), F.col(value).alias("_value")).distinct()
    order = W.partitionBy("_group").orderBy(F.desc("_value"))
    best = pairs.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= count)
    return rows.join(
        best, (F.col(group) == F.col("_group")) & (F.col(value) == F.col("_value"))
    ).drop("_group", "_value")


def sequence_in_group(rows: DataFrame, group: str, period: str, order: Sequence[str], name: str) -> DataFrame:
    """Running number per ``group`` by ``period`` and then ``order``. A group of any size, one period of it
    included, is spread over many parts."""
    return number_in_groups(rows, [group], [period, *order], name)

"""Parquet writes that count what passes through them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(
    frame: DataFrame, path: str, tallies: Mapping[str, Column] | None = None, *, partition_by: Sequence[str] = ()
) -> dict[str, int]:
    """Write ``frame`` to ``path`` (overwriting) and return its tallies: ``rows``, and each of ``tallies``,
    aggregates that give whole numbers.

    The counts come from the write's own last stage, task by task as each is committed, so nothing is
    scanned again and a task that is run twice counts once. An empty frame counts zero everywhere.
    """
    wanted = {"rows": F.count(F.lit(1)), **(tallies or {})}
    seen = Observation()
    writer = frame.observe(seen, *[c.alias(n) for n, c in wanted.items()]).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    # The optimizer may replace a frame it knows to be empty, and the observation with it.
    found = seen.get
    return {n: int(found.get(n) or 0) for n in wanted}

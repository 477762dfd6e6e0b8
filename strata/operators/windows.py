"""Trailing calendar means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trailing_mean(df: DataFrame, keys: Sequence[str], day: str, value: str,
                  windows: dict[str, int]) -> DataFrame:
    """For each ``{name: n}`` add ``sum(value)`` over the ``n`` calendar days
    ending on ``day`` (RANGE frame on ``unix_date``), divided by ``n``: days
    without rows count as zero and peers on the same day are all included.

    All frames share one partitioning and ordering, so Spark plans a single
    shuffle + sort + Window node for them.  The input should already be
    aggregated per (keys, day), which bounds each window partition by the
    number of calendar days, not by raw rows.
    """
    base = Window.partitionBy(*keys).orderBy(F.unix_date(F.col(day)))
    cols = {
        name: F.sum(value).over(base.rangeBetween(-(n - 1), 0)) / F.lit(n)
        for name, n in windows.items()
    }
    return df.withColumns(cols)

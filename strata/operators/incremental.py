"""Incremental selection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water(df: DataFrame, col: str):
    """Global ``max(col)`` as a driver scalar (one row comes back)."""
    return df.agg(F.max(col).alias("hw")).first()["hw"]


def since_high_water(df: DataFrame, col: str, mark) -> DataFrame:
    """Rows strictly newer than ``mark``; ``None`` (no state yet) keeps all.

    Taking the mark from the source batches already loaded (not from the
    deduplicated target) means no raw row is read twice (R-4).
    """
    if mark is None:
        return df
    return df.filter(F.col(col) > F.lit(mark))


def lookback(df: DataFrame, date_col: str, as_of, days: int = 7) -> DataFrame:
    """``date_col >= as_of - days``; NULL dates drop out.  On a table
    partitioned by ``date_col`` this is a partition filter."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return df.filter(F.col(date_col) >= F.date_sub(F.lit(as_of), days))

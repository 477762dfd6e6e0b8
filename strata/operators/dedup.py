"""Keep the newest version of each business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_VERSION_ORDER = ("_file_version", "_ingestion_ts", "_line_no")


def version_order(cols: Sequence[str | Column] = DEFAULT_VERSION_ORDER) -> list[Column]:
    """Descending order over version columns (NULLs last)."""
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None,
                 rank_col: str = "_rn") -> DataFrame:
    """One row per ``keys``: the first under ``order_by`` (default: version,
    then ingestion time, then line number, all descending: last line wins).

    ``row_number() = 1`` plans as WindowGroupLimit (partial before the shuffle,
    final after), so a hot key is already cut to one row per map partition
    before it is shuffled.
    """
    order = list(order_by) if order_by is not None else version_order()
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)

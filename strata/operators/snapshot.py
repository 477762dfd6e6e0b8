"""P5: newest dated snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, col: str = "_snapshot_date") -> DataFrame:
    """``where col = (select max(col) from df)``; empty input -> empty output.

    The scalar subquery stays in the plan, so on a table partitioned by
    ``col`` it becomes a runtime partition filter (only the newest snapshot is
    read) and no value passes through the driver.
    """
    return df.filter(F.col(col) == df.select(F.max(col)).scalar())

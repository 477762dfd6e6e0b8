"""date calendars without a cross join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _d(x):
    return dt.date.fromisoformat(x) if isinstance(x, str) else x


def day_sequence(first, last):
    """``sequence(first, last, 1 day)`` as a Column of ``array<date>``."""
    return F.sequence(F.lit(_d(first)), F.lit(_d(last)), F.expr("interval 1 day"))


def calendar(spark: SparkSession, first, last, name: str = "data_ref") -> DataFrame:
    """One row per day in [first, last]."""
    return spark.range(1).select(F.explode(day_sequence(first, last)).alias(name))


def explode_days(df: DataFrame, first, last, name: str = "data_ref") -> DataFrame:
    """Attach every day in [first, last] to every row of ``df`` with a
    generator (bounded fan-out per row, no cross join, no shuffle)."""
    return df.withColumn(name, F.explode(day_sequence(first, last)))

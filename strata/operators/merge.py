"""Keyed upsert without a transactional table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` repeat (a MERGE source must not repeat a key)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"merge source repeats keys {list(keys)}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 guard: Sequence[Column] | None = None, check_unique: bool = False) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted,
    other target rows stay.  NULL keys never match (plain equi-join).

    With ``guard`` (an order, newest first) a matched target row is replaced
    only when the source row is not older, so replaying an old batch is a
    no-op and full and incremental builds agree.
    """
    keys = list(keys)
    if check_unique:
        assert_unique(source, keys)
    source = source.select(*target.columns)
    if guard is None:
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.unionByName(source)
    # Guarded: rows with a NULL key pass through untouched on both sides.
    null_key = None
    for k in keys:
        null_key = F.col(k).isNull() if null_key is None else (null_key | F.col(k).isNull())
    both = target.unionByName(source)
    return dedup_latest(both.filter(~null_key), keys, guard).unionByName(both.filter(null_key))

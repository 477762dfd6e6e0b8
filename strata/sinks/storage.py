"""Parquet tables without a transactional format.

* ``append``            bag append, partitioned (raw, log, quarantine).
* ``replace_partitions`` dynamic partition overwrite: only the partitions
  present in the result are replaced, an empty result replaces nothing.
* ``replace_snapshot``  one dated snapshot partition; an empty extract raises
  and keeps the old snapshot.
* ``replace_table``     full rebuild into a fresh version folder, then a numbered
  pointer is appended; readers take the highest one, so a table can be rebuilt
  from itself (merge) and is readable at every moment.

Paths are whatever the caller passes: the cluster's shared folder
(``spark.checkpoint.dir``) or any other shared URI.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _writer(df: DataFrame, by: Sequence[str] | None, sort_by: Sequence[str] | None):
    if by:
        # Rows of one partition value together, but a large value (one snapshot
        # day) is split over tasks by size; sorted by the clustering columns so
        # Parquet min/max statistics prune well.
        df = df.hint("rebalance", *[F.col(c) for c in by])
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
        return df.write.partitionBy(*by)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return df.write


def append(df: DataFrame, path: str, by: Sequence[str] | None = None,
           sort_by: Sequence[str] | None = None, spread: bool = False) -> None:
    """Append-only write.  ``spread``: no shuffle, every task writes its own files (for constant ``by``)."""
    if spread:
        df.write.partitionBy(*by or ()).mode("append").option("compression", "zstd").parquet(path)
        return
    _writer(df, by, sort_by).mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], sort_by: Sequence[str] | None = None) -> None:
    """Dynamic partition overwrite (untouched partitions stay)."""
    _writer(df, by, sort_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def replace_snapshot(df: DataFrame, path: str, day: dt.date, batch_id: str, ts: dt.datetime) -> None:
    """K3 + K4: write ``df`` as the snapshot of ``day``; an empty extract
    raises before anything is touched."""
    if df.isEmpty():
        raise ValueError(f"{path}: empty extract, the snapshot of {day} stays as it is")
    out = df.withColumns({"_snapshot_date": F.lit(day), "_ingestion_ts": F.lit(ts), "_batch_id": F.lit(batch_id)})
    replace_partitions(out, path, ["_snapshot_date"])
    return None


def _pointer(path: str) -> str:
    return f"{path.rstrip('/')}/_current"


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version folder a ``replace_table`` table currently points to."""
    last = _newest(spark, path)
    return last[1] if last else None


def _newest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.schema("n long, version string").parquet(_pointer(path)).agg(
            F.max(F.struct("n", "version")).alias("last")).collect()          # one row
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return None                                          # no pointer: not a versioned table
    return tuple(rows[0][0]) if rows[0][0] else None


def replace_table(df: DataFrame, path: str, by: Sequence[str] | None = None,
                  sort_by: Sequence[str] | None = None) -> str:
    """K8/K9: write a new version folder, then switch the pointer.

    The old version stays readable until the pointer moves, so ``df`` may be
    computed from the table itself.  Returns the new version folder.
    """
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v_{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    _writer(df, by, sort_by).mode("errorifexists").parquet(version)
    # pointers are only ever added, the highest number wins: a reader always finds one
    last = _newest(spark, path)
    spark.createDataFrame([((last[0] if last else 0) + 1, version)], "n long, version string").coalesce(1) \
        .write.mode("append").parquet(_pointer(path))
    return version


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a table written by this module (pointer-resolved if versioned)."""
    target = current_version(spark, path) or path
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(target)

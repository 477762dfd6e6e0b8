"""Stored tables in key ranges: upsert, overwrite and publish without a transactional format.

    data/_range=<range>/_version=<id>/part-*    rows of one range, written once, never changed
    manifest/_version=<id>                      one row per live range: its version, rows, files, least and largest key
    commits                                     one row per version: number, id, state; the highest number is current

A change writes only the ranges it touches and a new manifest in which the other ranges keep their folders; it becomes
visible when its row in ``commits`` is appended.  The state in that row (high-water mark, finished epochs, schema)
therefore always describes exactly the data it is published with.  A writer that dies before leaves folders no manifest
names; the next attempt uses an id of its own.  One writer at a time.

``stage`` counts the failing rows of each check in the pass that writes (``observe``); ``publish`` moves on only if none
failed, so readers never see a version that broke a check.

The list of live ranges (one short row per range, chosen by the caller's range width) passes the driver as paths, which
is what Spark's own file index keeps for them anyway.  Folders of replaced versions stay for readers that still use them;
removing old ones is left to the storage's lifecycle rules.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE, VERSION = "_range", "_version"
SPREAD = "_spread"
NONE = "none"                                   # range of rows whose range expression is NULL
COMMITS = "n long, id string, state string"
MANIFEST = "_range string, _version string, n_rows long, n_files long, least string, largest string"


class GateError(RuntimeError):
    """A staged version broke a check; the version before it stays current."""


@dataclass(frozen=True)
class Current:
    n: int
    id: str
    state: dict


@dataclass(frozen=True)
class Staged:
    path: str
    n: int
    id: str
    schema: T.StructType
    n_rows: int
    failures: dict = field(default_factory=dict)

    def preview(self) -> Current:
        """What ``read`` takes to read this version before it is published."""
        return Current(self.n, self.id, {"schema": self.schema.jsonValue()})


def _missing(ex: AnalysisException) -> bool:
    return ex.getCondition() == "PATH_NOT_FOUND"


def current(spark: SparkSession, path: str) -> Current | None:
    """The published version, or None for a table that has none yet."""
    try:
        last = spark.read.schema(COMMITS).parquet(f"{path}/commits").agg(F.max(F.struct("n", "id", "state"))).first()[0]
    except AnalysisException as ex:
        if not _missing(ex):
            raise
        return None
    return Current(last["n"], last["id"], json.loads(last["state"])) if last else None


def manifest(spark: SparkSession, path: str, at: Current | None = None) -> DataFrame:
    """Live ranges of a version (the current one by default)."""
    at = at or current(spark, path)
    if at is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/_version={at.id}")


def range_of(value: Column) -> Column:
    """The text that names a row's range; NULL has a range of its own."""
    return F.coalesce(value.cast("string"), F.lit(NONE))


def by_range(rows: DataFrame, keys: Sequence[str], ranges: Column) -> DataFrame:
    """Rows of a range in one task, with the columns that say so; those without a range are spread by their keys.

    The columns are computed again behind the shuffle, so they do not move.
    """
    name = range_of(ranges)
    spread = F.when(name == NONE, F.pmod(F.xxhash64(*keys), F.lit(64))).otherwise(F.lit(0).cast("long"))
    return rows.repartition(name, spread).withColumns({RANGE: name, SPREAD: spread})


def read(spark: SparkSession, path: str, ranges: DataFrame | None = None, at: Current | None = None,
         schema: T.StructType | None = None) -> DataFrame:
    """Rows of the current version, or only those of ``ranges`` (a column ``_range``): nothing else is listed or read.

    ``schema`` is used for a table that does not exist yet (K12: create if missing); a stored table has its own.
    """
    at = at or current(spark, path)
    if at is not None:
        schema = T.StructType.fromJson(at.state["schema"])
    elif schema is None:
        raise ValueError(f"{path}: no such table and no schema given")
    live = manifest(spark, path, at)
    if ranges is not None:
        live = live.join(ranges.select(RANGE).distinct(), RANGE, "left_semi")
    folders = [f"{path}/data/{RANGE}={_escaped(r[RANGE])}/{VERSION}={r[VERSION]}" for r in live.select(RANGE, VERSION).collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def _escaped(name: str) -> str:
    """A range name as it stands in its folder: what Spark writes for characters that paths or Hive reserve."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in '"#%\'*/:=?\\{[]^\x7f' else c for c in name)


def stage(path: str, rows: DataFrame, ranges: Column, keys: Sequence[str], replaced: DataFrame | None = None,
          checks: Mapping[str, Column] | None = None, sort_by: Sequence[str] = (), placed: bool = False) -> Staged:
    """Write ``rows`` as a version that nobody reads yet.

    ``ranges``: the value that names a row's range.  ``replaced``: ranges (column ``_range``) that this version replaces,
    those without a row among ``rows`` are cleared; None replaces the whole table.  ``checks``: name -> condition that
    holds for a failing row, counted while writing.  ``placed``: the rows of a range already lie in few tasks.

    Files go to their folders as each task ends (committer 2): nobody reads a version before its row in ``commits``.
    """
    spark, was = rows.sparkSession, current(rows.sparkSession, path)
    n, checks = (was.n if was else 0) + 1, dict(checks or {})
    version = f"{n:06d}-{uuid.uuid4().hex[:8]}"
    seen = Observation(f"stage-{version}")
    out = rows.withColumn(RANGE, range_of(ranges)).observe(
        seen, F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"check_{i}") for i, c in enumerate(checks.values())])
    out = out.withColumn(VERSION, F.lit(version))
    out = (out if placed else out.hint("rebalance", RANGE)).sortWithinPartitions(RANGE, *(sort_by or keys))
    out.write.partitionBy(RANGE, VERSION).mode("append").option("compression", "zstd") \
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{path}/data")
    live = manifest(spark, path, was)
    live = live.limit(0) if replaced is None else live.join(replaced.select(RANGE).distinct(), RANGE, "left_anti")
    new = _measure(spark, path, version, rows.schema, keys)
    found = _metrics(seen, len(checks), new is None)
    if new is not None:
        live = live.unionByName(new)
    live.coalesce(1).write.parquet(f"{path}/manifest/_version={version}")
    return Staged(path, n, version, rows.schema, found["n_rows"],
                  {name: found[f"check_{i}"] for i, name in enumerate(checks) if found[f"check_{i}"]})


def _metrics(seen: Observation, n_checks: int, empty: bool) -> dict:
    """What the write counted.  A plan that the optimizer finds empty has no metrics, but then no folder either."""
    try:
        return seen.get
    except Py4JJavaError:
        if not empty:
            raise
        return {"n_rows": 0, **{f"check_{i}": 0 for i in range(n_checks)}}


def _measure(spark: SparkSession, path: str, version: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame | None:
    """Manifest rows of the folders a version wrote, None if it wrote none; only the key columns are read."""
    full = T.StructType([*[schema[k] for k in keys], T.StructField(RANGE, T.StringType()), T.StructField(VERSION, T.StringType())])
    try:
        new = spark.read.schema(full).option("basePath", f"{path}/data").parquet(f"{path}/data/{RANGE}=*/{VERSION}={version}")
    except AnalysisException as ex:
        if not _missing(ex):
            raise
        return None
    key = F.struct(*keys)
    return new.groupBy(RANGE, VERSION).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col("_metadata.file_name")).alias("n_files"),
        F.to_json(F.min(key)).alias("least"), F.to_json(F.max(key)).alias("largest"))


def audit(staged: Sequence[Staged]) -> None:
    """Raise if any of the staged versions broke a check."""
    bad = [f"{s.path}: " + ", ".join(f"{k}={v}" for k, v in sorted(s.failures.items())) for s in staged if s.failures]
    if bad:
        raise GateError("; ".join(bad))


def publish(spark: SparkSession, staged: Staged, state: Mapping[str, object] | None = None) -> Current:
    """Make a staged version current, together with ``state``; a version with failed checks raises instead (Q9)."""
    audit([staged])
    was = current(spark, staged.path)
    if (was.n if was else 0) != staged.n - 1:
        raise RuntimeError(f"{staged.path}: version {was.n} was published after {staged.id} was staged")
    full = {**(was.state if was else {}), **(state or {}), "schema": staged.schema.jsonValue()}
    spark.createDataFrame([(staged.n, staged.id, json.dumps(full))], COMMITS).coalesce(1) \
        .write.mode("append").parquet(f"{staged.path}/commits")
    return Current(staged.n, staged.id, full)

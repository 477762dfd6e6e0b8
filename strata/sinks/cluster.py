"""Clustering by several columns along a space-filling curve.

Sorting by (a, b) helps filters on ``a`` alone.  Here each column is cut into ranks of about equal size (approximate
quantiles, at most ``2 ** bits`` of them), the bits of a row's ranks are interleaved to its place on the Z-curve, and the
rows are range-partitioned and sorted by it: rows close in any of the columns lie in few files and row groups, so the
min/max statistics of Parquet prune for each of them.

The driver holds the quantiles only, at most ``2 ** bits`` numbers a column.  A value that many rows share is one rank; the
columns themselves break the tie, and rows equal in all columns may be split over files, so no file takes them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
ERROR = 0.001                                   # of the quantiles' ranks


def number(df: DataFrame, col: str) -> Column:
    """A column as a number in its own order: dates and times by their distance, text by its first bytes."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(col).cast("timestamp").cast("double")
    if isinstance(kind, T.StringType):          # six bytes fit a double exactly
        return F.conv(F.rpad(F.hex(F.substring(F.encode(col, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.col(col).cast("double")


def with_curve(df: DataFrame, columns: Sequence[str], out: str = "_curve", bits: int = BITS) -> DataFrame:
    """``df`` with each row's place on the curve; NULL ranks after all values."""
    names = [f"_rank_{i}" for i in range(len(columns))]
    ranked = df.withColumns({f"{n}_value": number(df, c) for n, c in zip(names, columns)})
    probabilities = [i / 2 ** bits for i in range(1, 2 ** bits)]
    cuts = ranked.approxQuantile([f"{n}_value" for n in names], probabilities, ERROR)
    place = F.lit(0).cast("long")
    for i, (n, c) in enumerate(zip(names, cuts)):
        splits = [-float("inf"), *(sorted(set(c)) or [0.0]), float("inf")]         # all NULL: any cut will do
        ranked = Bucketizer(splits=splits, inputCol=f"{n}_value", outputCol=n, handleInvalid="keep").transform(ranked)
        rank = F.col(n).cast("long")
        for b in range(bits + 1):               # the rank of NULL may need one more bit
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1))
            place = place + F.shiftleft(bit, b * len(columns) + i)
    return ranked.withColumn(out, place).drop(*names, *[f"{n}_value" for n in names])


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS) -> None:
    """Append ``df`` as ``files`` files clustered by ``columns``."""
    placed = with_curve(df, columns, bits=bits).withColumn("_tie", F.rand(7))
    order = ["_curve", *columns, "_tie"]
    placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_curve", "_tie") \
        .write.mode("append").parquet(path)

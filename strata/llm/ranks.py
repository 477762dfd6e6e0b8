"""Positions in a sorted table, without a window over a whole group.

The table is range-partitioned on (group, order), so a group that holds a third of all rows, or one id that stands on
them, lies in many partitions; a position is the row's place in its partition plus the rows of its group in earlier
partitions.  The only window runs over one row per (partition, group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.chunks import write_table

PLACE_BITS = 33                                 # monotonically_increasing_id: partition number << 33 | place


def ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0, in its group, by ``order`` ascending, nulls first) and ``n`` (size of the group).

    Rows that are equal in ``order`` get neighbouring positions in an order fixed by the first write.
    """
    spark = df.sparkSession
    fixed = write_table(df.withColumn("_row", F.monotonically_increasing_id()), "unranked")
    by = [F.col(c).asc_nulls_first() for c in (*group, *order, "_row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = fixed.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    laid = write_table(laid.drop("_row").withColumn("_at", F.monotonically_increasing_id()), "ranked")
    laid = laid.withColumn("_part", F.shiftright("_at", PLACE_BITS))
    spans = laid.groupBy(F.col("_part").alias("_p"), *[F.col(g).alias(f"_{g}") for g in group]).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*[f"_{g}" for g in group])
    earlier = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_p", *[f"_{g}" for g in group], "_first", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"),
                         F.sum("_c").over(whole).alias("n"))
    same = F.col("_part") == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return laid.join(spans, same).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"), "n")

"""Q1-Q5, Q9: data-quality checks that return the failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside ``values``; NULL passes (not_null covers it)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def unique_combination(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count.
    Partial aggregation collapses a hot key before the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join)."""
    parent_col = parent_col or col
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def freshness(df: DataFrame, ts_col: str, as_of_ts, warn_h: int = 26, error_h: int = 50,
              source: str | None = None) -> DataFrame:
    """One row: last load time, hours since it (fractional, as of ``as_of_ts``)
    and ``ok`` / ``warn`` / ``error``.  No row loaded at all is an error."""
    last = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("max_loaded_at"))
    secs = F.lit(as_of_ts).cast("timestamp").cast("long") - F.col("max_loaded_at").cast("long")
    hours = secs / F.lit(3600.0)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
               .when(hours > F.lit(error_h), F.lit("error"))
               .when(hours > F.lit(warn_h), F.lit("warn"))
               .otherwise(F.lit("ok")))
    out = last.select("max_loaded_at", hours.alias("hours_since_load"), status.alias("freshness"))
    if source is not None:
        out = out.select(F.lit(source).alias("source"), "*")
    return out


def run_checks(checks: Mapping[str, DataFrame]) -> DataFrame:
    """``{name: failing rows}`` -> one row per check with its failure count.

    Each count is a distributed aggregate; only the small summary is unioned.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(summary: DataFrame) -> None:
    """Q9: raise if any check failed (blocks publication)."""
    bad = summary.filter(F.col("failures") > 0).select("check", "failures").collect()
    if bad:
        raise RuntimeError("quality gate failed: " + ", ".join(f"{r['check']}={r['failures']}" for r in bad))


def flag_rows(df: DataFrame, flag: Column | str) -> DataFrame:
    """Q6: rows whose boolean flag is true (NULL is not a failure)."""
    f = F.col(flag) if isinstance(flag, str) else flag
    return df.filter(F.coalesce(f, F.lit(False)))

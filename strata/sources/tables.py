"""Reads with fixed schemas and contract projection of extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def empty(spark: SparkSession, schema) -> DataFrame:
    """An empty relation with a fixed schema (create-if-missing)."""
    return spark.createDataFrame([], schema)


def to_contract_strings(df: DataFrame, table: str) -> DataFrame:
    """Project an extract onto a dimension contract.

    Columns match case-insensitively; every value becomes a string (NULL kept);
    extra columns are dropped; a missing contract column raises.
    """
    expected = schemas.DIMENSION_COLUMNS[table]
    by_lower = {c.lower(): c for c in df.columns}
    missing = sorted(c.lower() for c in expected if c.lower() not in by_lower)
    if missing:
        raise ValueError(f"{table}: colunas ausentes: {missing}")
    return df.select(*[F.col(by_lower[c.lower()]).cast("string").alias(c) for c in expected])

"""Models built from a folder of the driver's tables (lazy DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import bronze, gold, silver
from strata.sources import adapters


def report(df: DataFrame) -> DataFrame:
    """Final projection for consumers: fixed-point money becomes double."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def bronze_pedido(spark: SparkSession, sf: str, order: str = "reference") -> DataFrame:
    return bronze.bronze_pedido(adapters.raw_pedido(spark, sf), order=order)


def bronze_item(spark: SparkSession, sf: str, order: str = "reference") -> DataFrame:
    return bronze.bronze_item_pedido(adapters.raw_item_pedido(spark, sf), order=order)


def bronze_dim(spark: SparkSession, sf: str, name: str) -> DataFrame:
    raw = {"unidade": adapters.raw_unidade, "estado": adapters.raw_estado, "pais": adapters.raw_pais,
           "produto": adapters.raw_produto}[name](spark, sf)
    return bronze.typed_dimension(raw, name)


def silver_unidade(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_unidade(bronze_dim(spark, sf, "unidade"), bronze_dim(spark, sf, "estado"),
                                 bronze_dim(spark, sf, "pais"))


def silver_pedido(spark: SparkSession, sf: str, as_of=None, incremental: bool = False) -> DataFrame:
    return silver.silver_pedido(bronze_pedido(spark, sf), bronze_item(spark, sf), silver_unidade(spark, sf),
                                as_of=as_of, incremental=incremental)


def silver_pedido_item(spark: SparkSession, sf: str, as_of=None, incremental: bool = False) -> DataFrame:
    return silver.silver_pedido_item(bronze_item(spark, sf), silver_pedido(spark, sf, as_of, incremental),
                                     bronze_dim(spark, sf, "produto"), as_of=as_of, incremental=incremental)


def silver_vendas_base(spark: SparkSession, sf: str, as_of=None, incremental: bool = False) -> DataFrame:
    return silver.silver_vendas_base(silver_pedido_item(spark, sf, as_of, incremental),
                                     as_of=as_of, incremental=incremental)


def gold_vendas_diarias(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_vendas_diarias(silver_pedido(spark, sf))

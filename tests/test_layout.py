"""Clustering along a curve, and the registry of declared tables."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.sinks import cluster, registry


def groups_read(path, col, low, high):
    """(row groups whose statistics meet [low, high], all row groups)."""
    hit = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().get_field_index(col)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            hit += not (s.max < low or s.min > high)
    return hit, total


def test_either_column_prunes(spark, tmpdir_path):
    n = 40_000
    df = spark.range(n).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"),
                               F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("int")).alias("b"),
                               F.when(F.col("id") % 50 > 0, F.lit("hot")).alias("c"))
    cluster.write_clustered(df, tmpdir_path, ["a", "b"], 64)
    assert sorted(map(tuple, spark.read.parquet(tmpdir_path).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    for col, low, high in (("a", 4000, 4100), ("b", dt.date(2021, 1, 1), dt.date(2021, 1, 7))):
        hit, total = groups_read(tmpdir_path, col, low, high)
        assert total == 64 and hit <= 24, (col, hit)                     # sorted by the other column alone it is all 64


def test_hot_values_and_nulls(spark, tmpdir_path):
    df = spark.range(8000).select("id", F.when(F.col("id") < 6000, F.lit("hot")).when(F.col("id") < 7000, F.lit(None))
                                  .otherwise(F.col("id").cast("string")).alias("s"), F.lit(None).cast("double").alias("d"))
    cluster.write_clustered(df, tmpdir_path, ["s", "d"], 8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmpdir_path}/*.parquet")]
    assert sum(sizes) == 8000 and max(sizes) < 3000                     # the hot value is dealt over files
    cluster.write_clustered(df.limit(0), tmpdir_path + "/none", ["s", "d"], 4)


def test_registry_creates_once_and_reads_typed(spark, tmpdir_path):
    assert sorted(registry.create(spark, tmpdir_path)) == sorted(registry.DECLARED)
    assert registry.create(spark, tmpdir_path) == []
    for name, schema in registry.DECLARED.items():
        got = registry.read(spark, tmpdir_path, name)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schema] and got.isEmpty()
    assert registry.read(spark, tmpdir_path + "/x", "quarantine").columns == schemas.QUARANTINE_SCHEMA.names


def test_drift_is_widened_or_refused(spark, tmpdir_path):
    table = T.StructType([T.StructField("Id", T.IntegerType(), False), T.StructField("v", T.DecimalType(6, 2)),
                          T.StructField("note", T.StringType())])
    registry.create(spark, tmpdir_path, {"t": table})
    put = lambda rows, ddl, **kw: registry.append(spark.createDataFrame(rows, ddl), tmpdir_path, "t", **kw)
    put([(1, None)], "ID smallint, note string")
    assert put([(2**40, "n", 7)], "id long, note string, more int", extra="add")["Id"].dataType == T.LongType()
    for rows, ddl in (([("x",)], "id string"), ([(1.5,)], "id double"), ([("y",)], "note string"),
                      ([(1, 2)], "id int, unknown int")):
        with pytest.raises(registry.SchemaDrift):
            put(rows, ddl)
    with pytest.raises(Exception, match="t.Id: NULL"):
        put([(None,)], "id long")
    got = sorted(map(tuple, registry.read(spark, tmpdir_path, "t").select("Id", "v", "note", "more").collect()))
    assert got == [(1, None, None, None), (2**40, None, "n", 7)]


def test_wider_types():
    d = T.DecimalType
    assert registry.wider(d(10, 2), d(8, 4)) == d(12, 4) and registry.wider(d(38, 0), d(38, 10)) is None
    assert registry.wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert registry.wider(T.ByteType(), T.LongType()) == T.LongType() and registry.wider(T.DateType(), T.StringType()) is None

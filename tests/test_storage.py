"""Replay-safe writes and the version pointer."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.sinks import storage
from strata.streaming.ingest import log_handler


def test_pointer_moves_forward_and_is_never_absent(spark, tmpdir_path):
    path = tmpdir_path + "/t"
    assert storage.current_version(spark, path) is None
    first = storage.replace_table(spark.range(3), path)
    second = storage.replace_table(storage.read_table(spark, path).where("id > 0"), path)
    assert storage.current_version(spark, path) == second != first
    assert storage.read_table(spark, path).count() == 2
    assert spark.read.parquet(path + "/_current").count() == 2          # added, not replaced


def test_a_replayed_micro_batch_changes_nothing(spark, tmpdir_path):
    handle = log_handler(lambda b: b.withColumn("processed_at", F.lit(dt.datetime(2024, 1, 2))), tmpdir_path + "/log", "ckpt")
    handle(spark.range(10), 0)
    handle(spark.range(10), 0)
    handle(spark.range(5), 1)
    assert spark.read.parquet(tmpdir_path + "/log").count() == 15


def test_money_is_exact_or_an_error(spark):
    df = spark.createDataFrame([(10_000_000_000, Decimal("2.00"))], "q long, p decimal(12,2)")
    assert df.select(C.money_product("q", "p")).first()[0] == Decimal("20000000000")
    big = spark.createDataFrame([(1, Decimal(10) ** 20)], "q long, p decimal(38,2)")
    with pytest.raises(Exception, match="out of range"):
        big.select(C.money_product("q", "p")).collect()

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import columns as C


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_removes_unicode_white_space(spark):
    out = _one(spark, C.clean, ["\t abc  ", "﻿def", None, "  "])
    assert out == ["abc", "def", None, ""]


def test_blank_to_null(spark):
    assert _one(spark, C.blank_to_null, [" ", "\t", "Rua A, 1 ", None]) == [None, None, "Rua A, 1", None]


def test_safe_int(spark):
    out = _one(spark, C.safe_int, ["12", " 12 ", "12.0", "12.7", "", "abc", "012", None])
    assert out == [12, 12, None, None, None, None, 12, None]


def test_parse_decimal_br(spark):
    out = _one(spark, C.parse_decimal_br, ["1.234,56", "1234.56", "1234,5", " 7,00 ", "1.234", "1,234.56", "x", None])
    assert out == [Decimal("1234.560000000"), Decimal("1234.560000000"), Decimal("1234.500000000"),
                   Decimal("7.000000000"), Decimal("1.234000000"), Decimal("1.234560000"), None, None]


def test_parse_date_br(spark):
    out = _one(spark, C.parse_date_br, ["07/10/2026", "7/10/2026", "2026-10-07", "7/10/2026 10:00",
                                        "31/02/2026", "7/1/2026 10:00", "07/10/26", None])
    d = dt.date(2026, 10, 7)
    assert out == [d, d, d, d, None, None, None, None]


def test_standardize(spark):
    assert _one(spark, C.standardize_status, [" finalizado", "Pendente\t", "CANCELADO", "outro", None]) == \
        ["FINALIZADO", "PENDENTE", "CANCELADO", None, None]
    assert _one(spark, C.standardize_tipo_pedido, ["Loja Online", "loja física", "LOJA FISICA", "x"]) == \
        ["ONLINE", "FISICA", "FISICA", None]


def test_money_product_keeps_scale(spark):
    df = spark.createDataFrame([(3, Decimal("0.333333333"))], "q bigint, p decimal(38,9)")
    r = df.select(C.money_product("q", "p").alias("v"))
    assert r.schema["v"].dataType.scale == 9
    assert r.first()["v"] == Decimal("0.999999999")


def test_differs_three_valued(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("1.005")), (Decimal("1.00"), Decimal("1.02")),
                                (None, Decimal("1"))], "a decimal(10,3), b decimal(10,3)")
    assert [r[0] for r in df.select(C.differs("a", "b")).collect()] == [False, True, None]


def test_mask_text(spark):
    out = _one(spark, lambda c: C.mask_text(c, "k1"), ["Rua A, 1", None])
    assert out[0].startswith("***") and len(out[0]) == 3 + 64 and out[1] is None
    assert _one(spark, lambda c: C.mask_text(c, "k2"), ["Rua A, 1"])[0] != out[0]

"""Q7 / Q8: delivery completeness grid and the D-1 report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.calendar import explode_days
from strata.operators.joins import enrich


def _d(x):
    return dt.date.fromisoformat(x) if isinstance(x, str) else x


def received_by_day(log: DataFrame, first=None, last=None) -> DataFrame:
    """Per (unit, day): did a LOADED file of each type arrive?  Aggregated
    map-side, so a unit with a huge log collapses before the shuffle."""
    if first is not None:
        log = log.filter(F.col("data_ref").between(F.lit(_d(first)), F.lit(_d(last))))
    loaded = F.col("status") == F.lit("LOADED")
    return (log.groupBy("id_unidade", "data_ref")
               .agg(F.max(F.coalesce((F.col("tipo") == F.lit("pedido")) & loaded, F.lit(False)))
                    .alias("enviou_pedido"),
                    F.max(F.coalesce((F.col("tipo") == F.lit("item_pedido")) & loaded, F.lit(False)))
                    .alias("enviou_item_pedido")))


def completeness(log: DataFrame, expected: DataFrame, names: DataFrame | None, as_of,
                 days: int = 14) -> DataFrame:
    """Grid of active expected units × the ``days`` days before ``as_of``
    with OK / PARCIAL / FALTANDO.

    The calendar is generated per unit (bounded fan-out ``days``), the log is
    pre-aggregated and restricted to the window before the join.
    """
    as_of = _d(as_of)
    first, last = as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)
    grid = explode_days(expected.filter(F.col("ativa")).select("id_unidade"), first, last)
    got = received_by_day(log, first, last)
    out = grid.join(got, ["id_unidade", "data_ref"], "left")
    if names is not None:
        out = enrich(out, names, "id_unidade", ["nome_unidade"])
    else:
        out = out.withColumn("nome_unidade", F.lit(None).cast("string"))
    p, i = F.col("enviou_pedido"), F.col("enviou_item_pedido")
    situacao = (F.when(p & i, F.lit("OK"))
                 .when(p | i, F.lit("PARCIAL"))
                 .otherwise(F.lit("FALTANDO")))
    return out.select(
        "data_ref", "id_unidade", "nome_unidade",
        F.coalesce(p, F.lit(False)).alias("enviou_pedido"),
        F.coalesce(i, F.lit(False)).alias("enviou_item_pedido"),
        situacao.alias("situacao"))


def missing_report(grid: DataFrame, as_of) -> DataFrame:
    """Units that did not deliver completely on D-1, ordered by unit, with the
    alert line for each."""
    d1 = _d(as_of) - dt.timedelta(days=1)
    rows = grid.filter((F.col("data_ref") == F.lit(d1)) & (F.col("situacao") != F.lit("OK")))
    return (rows.select("id_unidade",
                        F.coalesce(F.col("nome_unidade"), F.lit("?")).alias("nome_unidade"),
                        "situacao")
                .withColumn("mensagem", F.format_string("• %d %s: %s", "id_unidade", "nome_unidade", "situacao"))
                .orderBy("id_unidade"))

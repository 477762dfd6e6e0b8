"""Bronze: typed, standardised, one row per business key (M1-M6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import columns as C
from strata.operators.dedup import dedup_latest, version_order
from strata.operators.incremental import since_high_water
from strata.operators.merge import merge_upsert
from strata.operators.snapshot import latest_snapshot
from strata.sinks import ranges as R

PEDIDO_KEYS = ["id_unidade", "id_pedido"]
ITEM_KEYS = ["id_unidade", "id_pedido", "id_item_pedido"]
LINEAGE = ["_file_version", "_source_file", "_ingestion_ts", "_line_no"]

def zero():
    return F.lit(0).cast(schemas.MONEY)


def typed_projection(df: DataFrame, spec: dict[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """``select`` of named typed expressions plus pass-through columns."""
    return df.select(*[e.alias(n) for n, e in spec.items()], *keep)


def pedido_spec() -> dict[str, Column]:
    return {
        "id_unidade": C.safe_int("Id_Unidade"),
        "id_pedido": C.safe_int("Id_Pedido"),
        "tipo_pedido": C.standardize_tipo_pedido("Tipo_Pedido"),
        "data_pedido": C.parse_date_br("Data_Pedido"),
        "vlr_pedido": C.parse_decimal_br("Vlr_Pedido"),
        "endereco_entrega": C.blank_to_null("Endereco_Entrega"),
        "taxa_entrega": F.coalesce(C.parse_decimal_br("Taxa_Entrega"), zero()),
        "status": C.standardize_status("Status"),
    }


def item_spec() -> dict[str, Column]:
    return {
        "id_unidade": C.safe_int("_id_unidade"),      # the unit comes from the file path
        "id_pedido": C.safe_int("Id_Pedido"),
        "id_item_pedido": C.safe_int("Id_Item_Pedido"),
        "id_produto": C.safe_int("Id_Produto"),
        "qtd": C.safe_int("Qtd"),
        "vlr_item": C.parse_decimal_br("Vlr_Item"),
        "observacao": C.blank_to_null("Observacao"),
    }


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def source_date(col: str = "_source_file") -> Column:
    """Reference date taken from a landing path (``.../dt=YYYY-MM-DD/...``)."""
    return F.try_to_date(F.regexp_extract(F.col(col), r"dt=(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def dedup_order(order: str = "reference") -> list[Column]:
    """``reference``: version desc, ingestion time desc, line desc (a file's
    last line wins).  ``date_first``: the path date first, so the newest
    business day wins also on a full rebuild (R-3)."""
    base = version_order()
    if order == "date_first":
        return [source_date().desc_nulls_last()] + base
    return base


def _bronze(raw: DataFrame, spec: dict, keys: list[str], target: DataFrame | None,
            high_water, order: str, ranges: Column | None = None) -> DataFrame:
    src = since_high_water(raw, "_ingestion_ts", high_water)
    typed = typed_projection(src, spec, _lineage(raw))
    if ranges is None:
        fresh = dedup_latest(typed, keys, dedup_order(order))
    else:
        placed = R.by_range(typed, keys, ranges)
        fresh = dedup_latest(placed, [R.RANGE, R.SPREAD, *keys], dedup_order(order)).drop(R.RANGE, R.SPREAD)
    if target is None:
        return fresh
    guard = dedup_order(order) if order == "date_first" else None
    return merge_upsert(target, fresh, keys, guard=guard)


def bronze_pedido(raw: DataFrame, target: DataFrame | None = None, high_water=None,
                  order: str = "reference") -> DataFrame:
    """M1.  Full build when ``target`` is None, else incremental: rows after
    ``high_water`` are typed, de-duplicated and upserted into ``target``."""
    return _bronze(raw, pedido_spec(), PEDIDO_KEYS, target, high_water, order)


def bronze_item_pedido(raw: DataFrame, target: DataFrame | None = None, high_water=None,
                       order: str = "reference", ranges: Column | None = None) -> DataFrame:
    """M2 (same shape as M1, item grain).  ``ranges``: a full build is placed by key range, as ``ranges.stage`` writes it."""
    return _bronze(raw, item_spec(), ITEM_KEYS, target, high_water, order, ranges)


# Dimension contracts -> typed columns (M3-M6): ids to bigint, names trimmed.
DIMENSION_SPECS = {
    "unidade": {"id_unidade": ("Id_Unidade", "id"), "nome_unidade": ("Nome_Unidade", "text"),
                "id_estado": ("Id_Estado", "id")},
    "produto": {"id_produto": ("Id_Produto", "id"), "nome_produto": ("Nome_Produto", "text")},
    "estado": {"id_estado": ("Id_Estado", "id"), "id_pais": ("Id_Pais", "id"),
               "nome_estado": ("Nome_Estado", "text")},
    "pais": {"id_pais": ("Id_Pais", "id"), "nome_pais": ("Nome_Pais", "text")},
}


def typed_dimension(raw: DataFrame, name: str) -> DataFrame:
    """M3-M6: newest snapshot of a dimension, typed.  Full rebuild."""
    spec = {out: (C.safe_int(src) if kind == "id" else C.clean(src))
            for out, (src, kind) in DIMENSION_SPECS[name].items()}
    return typed_projection(latest_snapshot(raw, "_snapshot_date"), spec, ["_snapshot_date", "_ingestion_ts"])

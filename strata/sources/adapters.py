"""The driver's TPC-H-like tables presented as the domain's raw relations.

orders -> raw pedido, lineitem (+ unit through its order) -> raw item_pedido,
customer / nation / region / part -> dimension snapshots, events -> ingestion
log, documents -> landing files.  Values are printed the way stores send them
(Brazilian dates and decimals in several styles) so the bronze parsers do real
work; every adapter is a lazy projection (one join for the item unit).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import EXPECTED_COLUMNS
from strata.session import scratch_path
from strata.sources.tables import read_table

ONLINE_PRIORITIES = ["1-URGENT", "2-HIGH"]
SNAPSHOT_OLD = dt.date(2024, 1, 30)
SNAPSHOT_NEW = dt.date(2024, 1, 31)
LANDING_DATE = dt.date(2026, 10, 7)


def _br_thousands(x: Column) -> Column:
    """1234567.5 -> '1.234.567,50'."""
    return F.translate(F.format_number(x, 2), ",.", ".,")


def _plain(x: Column) -> Column:
    return F.format_string("%.2f", x)


def _comma(x: Column) -> Column:
    return F.replace(F.format_string("%.2f", x), F.lit("."), F.lit(","))


def raw_pedido(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    day = F.to_date("o_orderdate")
    unit = F.col("o_custkey").cast("string")
    online = pr.isin(ONLINE_PRIORITIES)
    date_txt = (F.when(pr == "1-URGENT", F.date_format(day, "dd/MM/yyyy"))
                 .when(pr == "2-HIGH", F.date_format(day, "yyyy-MM-dd"))
                 .when(pr == "3-MEDIUM", F.date_format(day, "d/M/yyyy"))
                 .when(pr == "4-NOT SPECIFIED", F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" 10:00")))
                 .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:30:00"))))
    x = F.col("o_totalprice")
    value_txt = (F.when(pr == "1-URGENT", _br_thousands(x))
                  .when(pr == "2-HIGH", _plain(x))
                  .when(pr == "3-MEDIUM", _comma(x))
                  .when(pr == "4-NOT SPECIFIED", F.concat(F.lit(" "), _plain(x), F.lit("\t")))
                  .otherwise(_br_thousands(x)))
    tipo_txt = (F.when(online, F.lit("LOJA ONLINE"))
                 .when(pr == "3-MEDIUM", F.lit(" Loja Física "))
                 .otherwise(F.lit("LOJA FISICA")))
    status_txt = (F.when(F.col("o_orderstatus") == "F", F.lit("Finalizado"))
                   .when(F.col("o_orderstatus") == "O", F.lit("pendente "))
                   .when(F.col("o_orderstatus") == "P", F.lit("\tCANCELADO"))
                   .otherwise(F.col("o_orderstatus")))
    addr = F.when(pr == "5-LOW", F.lit("   ")).otherwise(
        F.concat(F.lit("Rua "), unit, F.lit(", "), F.col("o_orderkey").cast("string")))
    fee = F.when(online, F.lit("5,00")).otherwise(F.lit(""))
    unit_txt = F.when(pr == "3-MEDIUM", F.concat(F.lit(" "), unit, F.lit(" "))).otherwise(unit)
    path = F.concat(F.lit("incoming/pedido/id_unidade="), unit, F.lit("/dt="),
                    F.date_format(day, "yyyy-MM-dd"), F.lit("/pedido.csv"))
    return o.select(
        unit_txt.alias("Id_Unidade"), F.col("o_orderkey").cast("string").alias("Id_Pedido"),
        tipo_txt.alias("Tipo_Pedido"), date_txt.alias("Data_Pedido"), value_txt.alias("Vlr_Pedido"),
        addr.alias("Endereco_Entrega"), fee.alias("Taxa_Entrega"), status_txt.alias("Status"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("interval 30 hours")).alias("_ingestion_ts"),
        path.alias("_source_file"), F.sha2(path, 256).alias("_file_hash"),
        F.lit(1).cast("bigint").alias("_file_version"), unit.alias("_id_unidade"),
        F.date_format(day, "yyyyMMdd").alias("_batch_id"),
        F.col("o_orderkey").alias("_line_no"), F.lit(None).cast("string").alias("_load_id"))


def raw_item_pedido(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    units = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey"))
    j = li.join(units, "l_orderkey", "inner")
    unit = F.col("o_custkey").cast("string")
    day = F.to_date("l_shipdate")
    rf = F.col("l_returnflag")
    x = F.col("l_extendedprice")
    value_txt = F.when(rf == "A", _comma(x)).when(rf == "N", _plain(x)).otherwise(_br_thousands(x))
    path = F.concat(F.lit("incoming/item_pedido/id_unidade="), unit, F.lit("/dt="),
                    F.date_format(day, "yyyy-MM-dd"), F.lit("/item_pedido.csv"))
    return j.select(
        F.col("l_orderkey").cast("string").alias("Id_Pedido"),
        F.col("l_linenumber").cast("string").alias("Id_Item_Pedido"),
        F.col("l_partkey").cast("string").alias("Id_Produto"),
        F.col("l_quantity").cast("bigint").cast("string").alias("Qtd"),
        value_txt.alias("Vlr_Item"),
        F.when(rf == "R", F.lit("devolvido")).otherwise(F.lit(" ")).alias("Observacao"),
        F.col("l_shipdate").cast("timestamp").alias("_ingestion_ts"),
        path.alias("_source_file"), F.sha2(path, 256).alias("_file_hash"),
        F.lit(1).cast("bigint").alias("_file_version"), unit.alias("_id_unidade"),
        F.date_format(day, "yyyyMMdd").alias("_batch_id"),
        F.col("l_partkey").alias("_line_no"), F.lit(None).cast("string").alias("_load_id"))


def _snapshot(df: DataFrame, day: dt.date) -> DataFrame:
    return df.withColumns({
        "_snapshot_date": F.lit(day),
        "_ingestion_ts": F.lit(dt.datetime.combine(day, dt.time(6, 0))),
        "_batch_id": F.lit(f"snap{day:%Y%m%d}"),
    })


def raw_unidade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the unit table: an older one with stale names and
    the current one; only the newest may reach bronze."""
    c = read_table(spark, sf_dir, "customer")
    base = [F.col("c_custkey").cast("string").alias("Id_Unidade"),
            F.col("c_nationkey").cast("string").alias("Id_Estado")]
    old = c.select(base[0], F.lower("c_name").alias("Nome_Unidade"), base[1])
    new = c.select(base[0], F.concat(F.lit(" "), F.col("c_name")).alias("Nome_Unidade"), base[1])
    return _snapshot(old, SNAPSHOT_OLD).unionByName(_snapshot(new, SNAPSHOT_NEW))


def raw_estado(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return _snapshot(n.select(F.col("n_nationkey").cast("string").alias("Id_Estado"),
                              F.col("n_regionkey").cast("string").alias("Id_Pais"),
                              F.col("n_name").alias("Nome_Estado")), SNAPSHOT_NEW)


def raw_pais(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    return _snapshot(r.select(F.col("r_regionkey").cast("string").alias("Id_Pais"),
                              F.col("r_name").alias("Nome_Pais")), SNAPSHOT_NEW)


def raw_produto(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return _snapshot(p.select(F.col("p_partkey").cast("string").alias("Id_Produto"),
                              F.col("p_name").alias("Nome_Produto")), SNAPSHOT_NEW)


def expected_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed ``unidades_esperadas``: every unit of the master table, active
    while its balance is not negative."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id_unidade"), (F.col("c_acctbal") >= 0).alias("ativa"))


def event_tipo() -> Column:
    return F.when(F.col("event_type").isin("click", "view", "error"), F.lit("pedido")).otherwise(F.lit("item_pedido"))


def ingestion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ``ops.ingestion_log``: unit = user, type by event kind,
    ``error`` = REJECTED else LOADED, day of ``ts`` = reference date,
    ``props`` = file hash; version = arrival order within (unit, type, day)."""
    e = read_table(spark, sf_dir, "events")
    path = F.concat(F.lit("incoming/"), event_tipo(), F.lit("/id_unidade="), F.col("user_id").cast("string"),
                    F.lit("/dt="), F.date_format("ts", "yyyy-MM-dd"), F.lit("/e"),
                    F.col("event_id").cast("string"), F.lit(".csv"))
    status = F.when(F.col("event_type") == "error", F.lit("REJECTED")).otherwise(F.lit("LOADED"))
    return e.select(
        path.alias("file_path"), F.col("props").alias("file_hash"), F.col("user_id").alias("id_unidade"),
        event_tipo().alias("tipo"), F.to_date("ts").alias("data_ref"),
        F.lit(None).cast("bigint").alias("file_version"), F.lit(None).cast("bigint").alias("row_count"),
        status.alias("status"), F.lit("events").alias("batch_id"),
        F.when(status == "REJECTED", F.lit("rejeitado")).alias("error"),
        F.col("ts").cast("timestamp").alias("processed_at"), F.col("event_id"), F.col("event_type"))


def landing_files(spark: SparkSession, sf_dir: str, data_ref: dt.date = LANDING_DATE) -> DataFrame:
    """documents as one batch of landing files of type ``pedido``: unit from
    ``source`` (``src12`` -> 12), one file per document, bytes = UTF-8 text."""
    d = read_table(spark, sf_dir, "documents")
    unit = F.regexp_extract("source", r"(\d+)$", 1)
    path = F.concat(F.lit("incoming/pedido/id_unidade="), unit, F.lit(f"/dt={data_ref:%Y-%m-%d}/doc_"),
                    F.col("doc_id").cast("string"), F.lit(".csv"))
    return d.select(path.alias("path"), F.encode("text", "UTF-8").alias("content"),
                    F.col("n_chars").alias("length"), "doc_id")


def write_landing_orders(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Render ``orders`` as real landing CSV files under ``root``: one file per
    (unit, year) at ``incoming/pedido/id_unidade=<nation>/dt=<year>-01-01/``,
    ``;``-separated, header first, values printed as stores send them (the
    nation of the customer plays the sending unit)."""
    rows = _landing_rows(spark, sf_dir)
    _write_landing(rows, root, EXPECTED_COLUMNS["pedido"])


def _landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with ``unit`` (nation of the customer) and ``dt`` (first day of the year) of the file they go to."""
    o = raw_pedido(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("_id_unidade"), F.col("c_nationkey").cast("string").alias("unit"))
    return o.join(cust, "_id_unidade").withColumn("Id_Unidade", F.col("unit")).withColumn(
        "dt", F.concat(F.substring(F.regexp_extract("_source_file", r"dt=(\d{4})", 1), 1, 4), F.lit("-01-01")))


def _write_landing(rows: DataFrame, root: str, cells: list, header: str | None = None, sep: str = ";") -> None:
    """One file per (unit, dt); ``cells`` are joined by ``sep`` under ``header`` (their names by default, none if '')."""
    header = sep.join(cells) if header is None else header
    line = F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in cells]).alias(header or "line")
    (rows.select(F.col("unit").alias("id_unidade"), "dt", line)
         .repartition("id_unidade", "dt")
         .write.mode("append").partitionBy("id_unidade", "dt")
         .option("header", bool(header)).option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{root.rstrip('/')}/incoming/pedido"))


# unit -> what is wrong with its files; units from 7 on are sound
MISSING, EXTRA, ODD_HEADER, SHORT, WRONG_UNIT, EMPTY, BAD_NAME = range(7)
FORCED, RESENT = 7, 8                           # sound, sent again: reloaded by request for one day, skipped
EXTRA_COLUMNS = 600


def write_broken_landing(spark: SparkSession, sf_dir: str, root: str, units: str) -> None:
    """Landing files like ``write_landing_orders``, with one kind of fault in each of the units 0 to 6.

    ``units``: a condition on ``unit`` that picks the files to write.
    """
    cols = EXPECTED_COLUMNS["pedido"]
    path = scratch_path(spark, "landing-rows")       # rendered once, read by every kind of file
    _landing_rows(spark, sf_dir).filter(units).select(*cols, "unit", "dt").write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    of = lambda u: rows.filter(F.col("unit") == F.lit(str(u)))
    more = [f"Obs_{i:03d}" for i in range(1, EXTRA_COLUMNS + 1)]
    odd = [f" {c.upper().replace('_', ' ')} " if i % 2 else c.lower() for i, c in enumerate(cols)]
    _write_landing(of(MISSING), root, cols[:-1])
    _write_landing(of(EXTRA), root, [*cols, *[F.lit("x")] * EXTRA_COLUMNS], ";".join(cols + more))
    _write_landing(of(ODD_HEADER), root, cols, "|".join(odd), "|")
    _write_landing(of(SHORT), root, cols[:-1], ";".join(cols))
    online = F.upper(F.trim("Tipo_Pedido")) == "LOJA ONLINE"
    other = F.when(online, F.lit(str(100 + WRONG_UNIT))).otherwise(F.col("Id_Unidade"))
    _write_landing(of(WRONG_UNIT).withColumn("Id_Unidade", other), root, cols)
    _write_landing(of(EMPTY).select("unit", "dt").distinct(), root, [F.lit(" \t ")], "")
    _write_landing(of(BAD_NAME).withColumn("unit", F.concat(F.lit("x"), "unit")), root, cols)
    _write_landing(rows.filter(F.col("unit").cast("int") > BAD_NAME), root, cols)

"""Stored tables in key ranges: upsert, state, gate, moved partitions and the stream with its ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import bronze as B
from strata.plans import stored as S
from strata.sinks import ranges as R
from strata.streaming.ingest import bronze_handler, bronze_stream

RAW = ("Id_Unidade string, Id_Pedido string, Tipo_Pedido string, Data_Pedido string, Vlr_Pedido string, Endereco_Entrega string, "
       "Taxa_Entrega string, Status string, _ingestion_ts timestamp, _source_file string, _file_version long, _line_no long")


def order(number, value, day, unit="1", status="Pendente", date=None, hours=0):
    path = f"incoming/pedido/id_unidade={unit}/dt={day}/p.csv"
    ts = dt.datetime.fromisoformat(day) + dt.timedelta(hours=30 + hours)
    return (unit, None if number is None else str(number), "LOJA ONLINE", date or day, str(value), "", "", status, ts, path, 1, 1)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def files(spark, path):
    """Live data files of the current version by range."""
    out = {}
    for r in R.manifest(spark, path).collect():
        names = spark.read.parquet(f"{path}/data/_range={r['_range']}/_version={r['_version']}").inputFiles()
        out[r["_range"]] = sorted(names)
    return out


def numbers(spark, path):
    return {r["id_pedido"]: float(r["vlr_pedido"]) for r in R.read(spark, path).collect()}


def test_upsert_rewrites_only_touched_ranges(spark, tmpdir_path):
    first = raw(spark, *[order(n, n, "2026-01-01") for n in (1, 2, 11, 12, 21, 31)])
    S.load_bronze(spark, tmpdir_path, first, "pedido", width=10)
    before = files(spark, tmpdir_path)
    assert sorted(before) == ["0", "1", "2", "3"]
    second = raw(spark, order(12, 99, "2026-01-02"), order(13, 13, "2026-01-02"), order(41, 41, "2026-01-02"))
    S.load_bronze(spark, tmpdir_path, first.unionByName(second), "pedido", width=10)
    after = files(spark, tmpdir_path)
    assert {r for r in before if before[r] == after[r]} == {"0", "2", "3"} and sorted(after) == ["0", "1", "2", "3", "4"]
    assert numbers(spark, tmpdir_path) == {1: 1, 2: 2, 11: 11, 12: 99, 13: 13, 21: 21, 31: 31, 41: 41}
    m = {r["_range"]: r for r in R.manifest(spark, tmpdir_path).collect()}
    assert m["1"]["n_rows"] == 3 and '"id_pedido":11' in m["1"]["least"] and '"id_pedido":13' in m["1"]["largest"]


def test_read_opens_only_asked_ranges(spark, tmpdir_path):
    S.load_bronze(spark, tmpdir_path, raw(spark, *[order(n, n, "2026-01-01") for n in (1, 11, 21)]), "pedido", width=10)
    one = spark.createDataFrame([("2",)], "_range string")
    got = R.read(spark, tmpdir_path, one)
    assert [r["id_pedido"] for r in got.collect()] == [21] and all("_range=2/" in f for f in got.inputFiles())
    assert R.read(spark, tmpdir_path, one.where("false")).columns == got.columns


def test_incremental_equals_full_whatever_the_batches(spark, tmpdir_path):
    rows = [order(n % 7, n, f"2026-01-{1 + n % 5:02d}", hours=n) for n in range(40)]
    full = B.bronze_pedido(raw(spark, *rows), order="date_first")
    want = {r["id_pedido"]: float(r["vlr_pedido"]) for r in full.collect()}
    rows.sort(key=lambda r: r[8])
    for cut in (5, 17, 30, 40, 40):
        S.load_bronze(spark, tmpdir_path, raw(spark, *rows[:cut]), "pedido", width=2)
    assert numbers(spark, tmpdir_path) == want
    assert R.current(spark, tmpdir_path).n == 4                          # the last run found nothing new


def test_crash_between_data_and_publish(spark, tmpdir_path):
    first, both = [order(1, 1, "2026-01-01")], [order(1, 1, "2026-01-01"), order(1, 2, "2026-01-02"), order(2, 2, "2026-01-02")]
    S.load_bronze(spark, tmpdir_path, raw(spark, *first), "pedido")
    dead = B.bronze_pedido(raw(spark, *both[1:]), order="date_first")
    R.stage(tmpdir_path, dead, S.key_range(), B.PEDIDO_KEYS)
    assert numbers(spark, tmpdir_path) == {1: 1}
    S.load_bronze(spark, tmpdir_path, raw(spark, *both), "pedido")
    assert numbers(spark, tmpdir_path) == {1: 2, 2: 2}
    assert R.current(spark, tmpdir_path).state["high_water"].startswith("2026-01-03 06:00")


def test_gate_keeps_the_old_version(spark, tmpdir_path):
    good, bad = raw(spark, order(1, 1, "2026-01-01")), raw(spark, order("x", 5, "2026-01-02"), order(2, 2, "2026-01-02"))
    S.load_bronze(spark, tmpdir_path, good, "pedido")
    with pytest.raises(R.GateError, match="not_null_id_pedido=1"):
        S.load_bronze(spark, tmpdir_path, good.unionByName(bad), "pedido")
    assert numbers(spark, tmpdir_path) == {1: 1} and R.current(spark, tmpdir_path).n == 1
    S.load_bronze(spark, tmpdir_path, good.unionByName(bad.where("Id_Pedido <> 'x'")), "pedido")
    assert numbers(spark, tmpdir_path) == {1: 1, 2: 2}


def test_stale_stage_is_refused(spark, tmpdir_path):
    rows = B.bronze_pedido(raw(spark, order(1, 1, "2026-01-01")))
    a, b = (R.stage(tmpdir_path, rows, S.key_range(), B.PEDIDO_KEYS) for _ in range(2))
    R.publish(spark, a)
    with pytest.raises(RuntimeError, match="after"):
        R.publish(spark, b)


def test_null_and_odd_range_names(spark, tmpdir_path):
    df = spark.createDataFrame([(1, None), (2, "a/b=c"), (3, "ü x"), (4, "50%"), (5, "a:b")], "id long, name string")
    R.publish(spark, R.stage(tmpdir_path, df, F.col("name"), ["id"]))
    assert sorted(map(tuple, R.read(spark, tmpdir_path).collect())) == sorted(map(tuple, df.collect()))


def test_empty_table_and_missing_table(spark, tmpdir_path):
    schema = B.bronze_pedido(raw(spark, order(1, 1, "2026-01-01"))).schema
    assert R.read(spark, tmpdir_path + "/x", schema=schema).count() == 0
    with pytest.raises(ValueError):
        R.read(spark, tmpdir_path + "/x")
    empty = spark.createDataFrame([], schema)
    R.publish(spark, R.stage(tmpdir_path + "/y", empty, S.key_range(), B.PEDIDO_KEYS))
    assert R.read(spark, tmpdir_path + "/y").schema == schema and R.read(spark, tmpdir_path + "/y").count() == 0
    assert S.load_bronze(spark, tmpdir_path + "/z", raw(spark, order(1, 1, "2026-01-01")).limit(0), "pedido") is None


def test_moved_order_appears_once(spark, tmpdir_path):
    bronze, silver = tmpdir_path + "/b", tmpdir_path + "/s"
    units = spark.createDataFrame([(1, "u", "e")], "id_unidade long, nome_unidade string, nome_estado string")
    items = spark.createDataFrame([(1, 1, 2, 3.0, dt.datetime(2026, 1, 2))],
                                  "id_unidade long, id_pedido long, qtd long, vlr_item decimal(38,9), _ingestion_ts timestamp"
                                  .replace("decimal(38,9)", "double")).withColumn("vlr_item", F.col("vlr_item").cast("decimal(38,9)"))
    rows = [order(1, 1, "2026-01-01"), order(2, 2, "2026-01-01", date="2025-12-31"), order(3, 3, "2026-01-03")]
    S.load_bronze(spark, bronze, raw(spark, *rows), "pedido")
    S.load_silver(spark, silver, R.read(spark, bronze), items, units)
    before = files(spark, silver)
    assert sorted(before) == ["2025-12-31", "2026-01-01", "2026-01-03"]
    rows += [order(2, 2, "2026-01-05", date="2026-01-01")]
    S.load_bronze(spark, bronze, raw(spark, *rows), "pedido")
    S.load_silver(spark, silver, R.read(spark, bronze), items, units)
    after = files(spark, silver)
    assert sorted(after) == ["2026-01-01", "2026-01-03"]                # the partition it left is cleared
    assert after["2026-01-03"] == before["2026-01-03"] and after["2026-01-01"] != before["2026-01-01"]
    got = sorted((r["id_pedido"], str(r["data_pedido"]), r["qtd_itens"]) for r in R.read(spark, silver).collect())
    assert got == [(1, "2026-01-01", 2), (2, "2026-01-01", 0), (3, "2026-01-03", 0)]
    late = items.withColumns({"id_pedido": F.lit(3).cast("long"), "_ingestion_ts": F.lit(dt.datetime(2026, 3, 1))})
    S.load_silver(spark, silver, R.read(spark, bronze), items.unionByName(late), units)       # an item changes its order
    assert files(spark, silver)["2026-01-01"] == after["2026-01-01"]
    assert {r["id_pedido"]: r["qtd_itens"] for r in R.read(spark, silver).collect()} == {1: 2, 2: 0, 3: 2}


def test_stream_replays_and_restarts(spark, tmpdir_path):
    src, table, ckpt = (f"{tmpdir_path}/{n}" for n in ("in", "table", "ckpt"))
    a = raw(spark, order(1, 1, "2026-01-01"), order(11, 11, "2026-01-01"))
    b = raw(spark, order(1, 5, "2026-01-02"))
    a.coalesce(1).write.parquet(src)
    run = lambda: bronze_stream(spark, src, a.schema, ckpt, "pedido", table, width=10, files_per_batch=1)
    run()
    before = files(spark, table)
    b.coalesce(1).write.mode("append").parquet(src)
    run()
    assert numbers(spark, table) == {1: 5, 11: 11} and files(spark, table)["1"] == before["1"]
    n = R.current(spark, table).n
    handle = bronze_handler(spark, "pedido", table, ckpt, width=10)
    handle(b, 1)                                                        # the micro-batch that is already in
    run()
    assert R.current(spark, table).n == n and numbers(spark, table) == {1: 5, 11: 11}


def test_transform_run_publishes_all_layers_or_none(spark, tmpdir_path):
    units = spark.createDataFrame([(1, "u", "e")], "id_unidade long, nome_unidade string, nome_estado string")
    items = spark.createDataFrame([], "Id_Pedido string, Id_Item_Pedido string, Id_Produto string, Qtd string, Vlr_Item string, "
                                      "Observacao string, _ingestion_ts timestamp, _source_file string, _file_version long, "
                                      "_line_no long, _id_unidade string")
    item = [("1", "1", "5", "2", "3,50", "", dt.datetime(2026, 1, 2), "incoming/item_pedido/id_unidade=1/dt=2026-01-01/i.csv", 1, 1, "1")]
    some = spark.createDataFrame(item, items.schema)
    first = raw(spark, order(1, 7, "2026-01-01", status="Finalizado"))
    both = first.unionByName(raw(spark, order(2, 9, "2026-01-05")))
    names = ["bronze_pedido", "bronze_item_pedido", "silver_pedido", *S.DAILY_GOLD]
    assert S.transform(spark, tmpdir_path, first, some, units) == names
    assert S.transform(spark, tmpdir_path, first, some, units) == []
    with pytest.raises(R.GateError):
        S.transform(spark, tmpdir_path, both, some, units, checks={"gold_ticket_medio": {"any": F.col("qtd_finalizados") == 0}})
    assert {R.current(spark, f"{tmpdir_path}/{n}").n for n in names} == {1}
    before = files(spark, f"{tmpdir_path}/gold_vendas_diarias")
    assert "bronze_item_pedido" not in S.transform(spark, tmpdir_path, both, some, units)
    after = files(spark, f"{tmpdir_path}/gold_vendas_diarias")
    assert sorted(after) == ["2026-01-01", "2026-01-05"] and after["2026-01-01"] == before["2026-01-01"]
    got = {str(r["data_pedido"]): (r["qtd_pedidos"], float(r["faturamento"]))
           for r in R.read(spark, f"{tmpdir_path}/gold_vendas_diarias").collect()}
    assert got == {"2026-01-01": (1, 7.0), "2026-01-05": (1, 0.0)}


def exchanges(df):
    df.collect()                                     # the adaptive plan is final once it ran
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_upsert_moves_rows_once_and_keeps_rows_without_key(spark):
    keys, by = B.PEDIDO_KEYS, B.dedup_order("date_first")
    typed = lambda *rows: B.typed_projection(raw(spark, *rows), B.pedido_spec(), B.LINEAGE)
    old = typed(order(1, 1, "2026-01-01"), order(2, 2, "2026-01-09"), order(None, 3, "2026-01-01"))
    new = typed(order(1, 10, "2026-01-02"), order(1, 11, "2026-01-03"), order(2, 20, "2026-01-02"), order(5, 5, "2026-01-02"),
                order(None, 4, "2026-01-02"), order(None, 6, "2026-01-03"))
    values = lambda df: sorted((r["id_pedido"] or 0, int(r["vlr_pedido"])) for r in df.collect())
    got = S.upserted(old, new, keys, S.key_range(10), by)
    assert values(got) == [(0, 3), (0, 6), (1, 11), (2, 2), (5, 5)] and exchanges(got) == 1
    assert values(S.upserted(old, new, keys, S.key_range(10), by, guarded=False)) == [(0, 3), (0, 6), (1, 11), (2, 20), (5, 5)]
    assert exchanges(S.upserted(None, new, keys, S.key_range(10), by)) == 1


def test_range_full_of_new_rows_is_cut_before_it_moves(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(S, "CROWDED", 2)
    rows = [order(1, n, f"2026-01-{n:02d}") for n in range(1, 6)]
    S.load_bronze(spark, tmpdir_path, raw(spark, *rows), "pedido", width=10)
    assert numbers(spark, tmpdir_path) == {1: 5}


def test_full_build_by_range_is_the_plain_one(spark):
    items = spark.createDataFrame([(str(n % 4), "1", "7", str(n), "1,00", "", dt.datetime(2026, 1, 1 + n), "p", 1, n, "3")
                                   for n in range(8)] + [(None, "1", "7", "1", "1,00", "", dt.datetime(2026, 1, 1), "p", 1, 1, "3")],
                                  "Id_Pedido string, Id_Item_Pedido string, Id_Produto string, Qtd string, Vlr_Item string, "
                                  "Observacao string, _ingestion_ts timestamp, _source_file string, _file_version long, "
                                  "_line_no long, _id_unidade string")
    placed = B.bronze_item_pedido(items, order="date_first", ranges=S.key_range(2))
    assert sorted(map(str, placed.collect())) == sorted(map(str, B.bronze_item_pedido(items, order="date_first").collect()))
    assert exchanges(placed) == 1

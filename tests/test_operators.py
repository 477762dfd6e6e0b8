import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.completeness import completeness, missing_report
from strata.operators.dedup import dedup_latest
from strata.operators.merge import merge_upsert
from strata.operators.windows import trailing_mean
from strata.plans import bronze as B


def test_dedup_last_line_wins(spark):
    rows = [(1, 1, 1, dt.datetime(2026, 1, 1), 1, "a"), (1, 1, 1, dt.datetime(2026, 1, 1), 2, "b"),
            (1, 2, 2, dt.datetime(2026, 1, 1), 1, "c"), (1, 2, 1, dt.datetime(2026, 1, 2), 9, "d")]
    df = spark.createDataFrame(rows, "k long, id long, _file_version long, _ingestion_ts timestamp, "
                                     "_line_no long, v string")
    out = {r["id"]: r["v"] for r in dedup_latest(df, ["k", "id"]).collect()}
    assert out == {1: "b", 2: "c"}


def test_dedup_plan_uses_window_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("_file_version"),
                                 F.col("id").alias("_ingestion_ts"), F.col("id").alias("_line_no"))
    plan = dedup_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_merge_upsert_matches_dict_model(spark):
    rnd = random.Random(7)
    for _ in range(3):
        tgt = {k: rnd.randint(0, 99) for k in rnd.sample(range(30), 15)}
        src = {k: rnd.randint(100, 199) for k in rnd.sample(range(30), 10)}
        t = spark.createDataFrame(list(tgt.items()), "k long, v long")
        s = spark.createDataFrame(list(src.items()), "k long, v long")
        got = {r["k"]: r["v"] for r in merge_upsert(t, s, ["k"]).collect()}
        assert got == {**tgt, **src}


def test_merge_guard_keeps_newer_target(spark):
    t = spark.createDataFrame([(1, 5, "new"), (2, 1, "old")], "k long, ver long, v string")
    s = spark.createDataFrame([(1, 3, "older"), (2, 2, "newer"), (3, 1, "ins")], "k long, ver long, v string")
    got = {r["k"]: r["v"] for r in merge_upsert(t, s, ["k"], guard=[F.col("ver").desc()]).collect()}
    assert got == {1: "new", 2: "newer", 3: "ins"}


def test_merge_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "a")], "k long, v string")
    s = spark.createDataFrame([(None, "b")], "k long, v string")
    assert merge_upsert(t, s, ["k"]).count() == 2


def test_trailing_mean_against_brute_force(spark):
    # Sales on days 1, 7, 8, 28, 29; a renamed product gives two peers on day 8.
    base = dt.date(2026, 1, 1)
    rows = [(1, 1, base + dt.timedelta(days=d - 1), name, q) for d, name, q in
            [(1, "p", 10), (7, "p", 5), (8, "p", 3), (8, "p2", 4), (28, "p2", 1), (29, "p2", 2)]]
    df = spark.createDataFrame(rows, "u long, p long, d date, name string, q long")
    out = trailing_mean(df, ["u", "p"], "d", "q", {"m7": 7, "m28": 28}).collect()
    for r in out:
        w7 = sum(x[4] for x in rows if 0 <= (r["d"] - x[2]).days <= 6)
        w28 = sum(x[4] for x in rows if 0 <= (r["d"] - x[2]).days <= 27)
        assert r["m7"] == w7 / 7 and r["m28"] == w28 / 28


def test_completeness_states(spark):
    # Unit 1 both, unit 2 one type, unit 3 nothing, unit 4 inactive.
    as_of = dt.date(2026, 10, 8)
    d1 = as_of - dt.timedelta(days=1)
    log = spark.createDataFrame([(1, d1, "pedido", "LOADED"), (1, d1, "item_pedido", "LOADED"),
                                 (2, d1, "pedido", "LOADED"), (2, d1, "item_pedido", "REJECTED")],
                                "id_unidade long, data_ref date, tipo string, status string")
    exp = spark.createDataFrame([(1, True), (2, True), (3, True), (4, False)], "id_unidade long, ativa boolean")
    names = spark.createDataFrame([(1, "Um"), (2, "Dois")], "id_unidade long, nome_unidade string")
    grid = completeness(log, exp, names, as_of, 14)
    assert grid.count() == 3 * 14
    day = {r["id_unidade"]: r["situacao"] for r in grid.filter(F.col("data_ref") == d1).collect()}
    assert day == {1: "OK", 2: "PARCIAL", 3: "FALTANDO"}
    rep = [(r["id_unidade"], r["nome_unidade"], r["situacao"]) for r in missing_report(grid, as_of).collect()]
    assert rep == [(2, "Dois", "PARCIAL"), (3, "?", "FALTANDO")]


def test_quality_checks(spark):
    # NULL, unknown domain value, duplicate key, orphan.
    df = spark.createDataFrame([(1, 1, "PENDENTE", 10), (1, 1, "X", 11), (1, 2, None, None)],
                               "u long, p long, status string, prod long")
    parent = spark.createDataFrame([(10,)], "prod long")
    assert Q.not_null(df, "status").count() == 1
    assert Q.accepted_values(df, "status", ["PENDENTE"]).count() == 1
    assert Q.unique_combination(df, ["u", "p"]).count() == 1
    assert Q.relationships(df, "prod", parent).count() == 1
    summary = Q.run_checks({"a": Q.not_null(df, "status"), "b": Q.not_null(df, "u")})
    assert {r["check"]: r["failures"] for r in summary.collect()} == {"a": 1, "b": 0}


def test_freshness_levels(spark):
    # 25 h ok, 27 h warn, 51 h error.
    now = dt.datetime(2026, 10, 8, 12, 0)
    for hours, want in [(25, "ok"), (27, "warn"), (51, "error")]:
        df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "_ingestion_ts timestamp")
        assert Q.freshness(df, "_ingestion_ts", now).first()["freshness"] == want


def test_bronze_full_vs_incremental_date_first(spark):
    # Pendente on day 1 (v2) and Finalizado on day 3 (v1).
    def raw(rows):
        return spark.createDataFrame(rows, "Id_Unidade string, Id_Pedido string, Tipo_Pedido string, "
                                           "Data_Pedido string, Vlr_Pedido string, Endereco_Entrega string, "
                                           "Taxa_Entrega string, Status string, _ingestion_ts timestamp, "
                                           "_source_file string, _file_version long, _line_no long")
    day1 = ("12", "1", "Loja Online", "01/10/2026", "10,00", "", "", "Pendente", dt.datetime(2026, 10, 2),
            "incoming/pedido/id_unidade=12/dt=2026-10-01/p.csv", 2, 2)
    day3 = ("12", "1", "Loja Online", "01/10/2026", "10,00", "", "", "Finalizado", dt.datetime(2026, 10, 4),
            "incoming/pedido/id_unidade=12/dt=2026-10-03/p.csv", 1, 2)
    full_ref = B.bronze_pedido(raw([day1, day3])).first()["status"]
    assert full_ref == "PENDENTE"          # the reference order lets day 1's v2 win a full rebuild
    inc_ref = B.bronze_pedido(raw([day3]), target=B.bronze_pedido(raw([day1]))).first()["status"]
    assert inc_ref == "FINALIZADO"
    full_df = B.bronze_pedido(raw([day1, day3]), order="date_first").first()["status"]
    inc_df = B.bronze_pedido(raw([day3]), target=B.bronze_pedido(raw([day1]), order="date_first"),
                             order="date_first").first()["status"]
    assert full_df == inc_df == "FINALIZADO"

"""Golden landing fixtures (FIXTURES.md §4) written into a temp folder."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.plans import ingest as I
from strata.sources.tables import empty

HDR_P = "Id_Unidade;Id_Pedido;Tipo_Pedido;Data_Pedido;Vlr_Pedido;Endereco_Entrega;Taxa_Entrega;Status"
HDR_I = "Id_Pedido;Id_Item_Pedido;Id_Produto;Qtd;Vlr_Item;Observacao"
TS = dt.datetime(2026, 10, 8, 6, 0)


def _write(root, rel, data):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as fh:
        fh.write(data if isinstance(data, bytes) else data.encode("utf-8"))


def _run(spark, root, log=None, **kw):
    log = log if log is not None else empty(spark, schemas.INGESTION_LOG_SCHEMA)
    return I.landing_batch(spark, root, log, "batch1", TS, **kw)


def _by_path(df, col):
    return {r["path"].split("/incoming/")[-1] if "/incoming/" in r["path"] else r["path"]: r[col]
            for r in df.collect()}


def test_validation_fixtures(spark, tmpdir_path):
    root = tmpdir_path
    # BOM, ';', header with blanks/case in another order.
    _write(root, "incoming/pedido/id_unidade=12/dt=2026-10-07/x1.csv",
           "﻿ id pedido;Id_Unidade;tipo_pedido;Data_Pedido;Vlr_Pedido;Endereco_Entrega;Taxa_Entrega;Status\n"
           "1001;12;Loja Online;07/10/2026;1.234,56;Rua A, 1;5,00;Finalizado\n")
    # Latin-1 bytes.
    _write(root, "incoming/pedido/id_unidade=13/dt=2026-10-07/x2.csv",
           (HDR_P + "\n13;1;Loja Física;07/10/2026;10,00;;;Pendente\n").encode("latin-1"))
    # 0-byte and white-space-only files.
    _write(root, "incoming/pedido/id_unidade=14/dt=2026-10-07/x3a.csv", b"")
    _write(root, "incoming/pedido/id_unidade=15/dt=2026-10-07/x3b.csv", " \n\t\n")
    # One column missing, one extra.
    _write(root, "incoming/item_pedido/id_unidade=12/dt=2026-10-07/x4.csv",
           "Id_Pedido;Id_Item_Pedido;Id_Produto;Qtd;Vlr_Item;Extra\n1;1;1;1;1;x\n")
    # Short and long records, a blank line, a quoted newline.
    _write(root, "incoming/item_pedido/id_unidade=16/dt=2026-10-07/x5.csv",
           HDR_I + "\n1;1;1;2\n\n1;2;1;1;1,0;\"obs\nlinha\"\n1;3;1;1;1;a;b\n")
    # Content unit differs from the path unit.
    _write(root, "incoming/pedido/id_unidade=17/dt=2026-10-07/x6.csv",
           HDR_P + "\n13;1;Loja Online;07/10/2026;1;;;Pendente\n017;2;Loja Online;07/10/2026;1;;;Pendente\n")
    # Header only.
    _write(root, "incoming/item_pedido/id_unidade=18/dt=2026-10-07/x7.csv", HDR_I + "\n")
    # Bad path and impossible date.
    _write(root, "incoming/pedido/unit12/x.csv", HDR_P + "\n")
    _write(root, "incoming/pedido/id_unidade=12/dt=2026-02-31/x.csv", HDR_P + "\n")
    out = _run(spark, root)
    plan = out["plan"].collect()
    act = {r["rel"]: r["action"] for r in plan}
    err = {r["rel"]: r["errors"] for r in plan}
    p = "incoming/pedido/id_unidade="
    i = "incoming/item_pedido/id_unidade="
    assert act[p + "12/dt=2026-10-07/x1.csv"] == "LOAD"
    assert act[p + "13/dt=2026-10-07/x2.csv"] == "LOAD"
    assert err[p + "14/dt=2026-10-07/x3a.csv"] == ["arquivo vazio"]
    assert err[p + "15/dt=2026-10-07/x3b.csv"] == ["arquivo vazio"]
    assert err[i + "12/dt=2026-10-07/x4.csv"] == ["colunas ausentes: ['Observacao']",
                                                  "colunas inesperadas: ['Extra']"]
    assert err[i + "16/dt=2026-10-07/x5.csv"] == ["linha 2: 4 colunas (esperado 6)",
                                                  "linha 5: 7 colunas (esperado 6)"]
    assert err[p + "17/dt=2026-10-07/x6.csv"] == ["Id_Unidade do conteúdo ['017', '13'] diverge do caminho (17)"]
    assert act[i + "18/dt=2026-10-07/x7.csv"] == "LOAD"
    # raw rows keep values as received, with lineage
    raw_p = {r["Id_Pedido"]: r for r in out["raw"]["pedido"].collect()}
    assert raw_p["1001"]["Vlr_Pedido"] == "1.234,56" and raw_p["1001"]["_file_version"] == 1
    assert raw_p["1"]["Tipo_Pedido"] == "Loja Física"
    assert raw_p["1001"]["_load_id"].startswith("load_pedido_12_20261007_")
    log = out["log"].collect()
    loaded = {r["file_path"].split("/")[-1]: r["row_count"] for r in log if r["status"] == "LOADED"}
    assert loaded["x7.csv"] == 0 and loaded["x1.csv"] == 1
    names = {r["file_path"].split("incoming/")[-1] for r in log if r["error"] == "nome fora do padrão"}
    assert names == {"pedido/unit12/x.csv", "pedido/id_unidade=12/dt=2026-02-31/x.csv"}
    q = {r["file_path"].split("/")[-1]: (r["reason"], r["details"]) for r in out["quarantine"].collect()}
    assert q["x4.csv"] == ("VALIDACAO_FALHOU",
                           '["colunas ausentes: [\'Observacao\']", "colunas inesperadas: [\'Extra\']"]')
    summary = {r["status"]: r["n_files"] for r in out["summary"].collect()}
    assert summary == {"LOADED": 3, "REJECTED": 7}


def test_rerun_duplicates_versions_and_forced(spark, tmpdir_path):
    root = tmpdir_path
    body = HDR_P + "\n12;1;Loja Online;07/10/2026;1;;;Pendente\n"
    _write(root, "incoming/pedido/id_unidade=12/dt=2026-10-07/a.csv", body)
    first = _run(spark, root)
    log = first["log"]
    assert {r["rel"]: (r["action"], r["file_version"]) for r in first["plan"].collect()} == \
        {"incoming/pedido/id_unidade=12/dt=2026-10-07/a.csv": ("LOAD", 1)}
    # The same bytes again -> duplicate; X10: a corrected file -> v2;
    # Two equal new files in one batch -> first loads, second skips.
    root2 = tmpdir_path + "-2"
    _write(root2, "incoming/pedido/id_unidade=12/dt=2026-10-07/a.csv", body)
    _write(root2, "incoming/pedido/id_unidade=12/dt=2026-10-07/b.csv", body.replace("Pendente", "Finalizado"))
    _write(root2, "incoming/pedido/id_unidade=12/dt=2026-10-08/c.csv", body.replace("1;;;", "2;;;"))
    _write(root2, "incoming/pedido/id_unidade=12/dt=2026-10-09/d.csv", body.replace("1;;;", "2;;;"))
    second = _run(spark, root2, log=log)
    got = {r["rel"].split("/")[-1]: (r["action"], r["file_version"]) for r in second["plan"].collect()}
    assert got == {"a.csv": ("SKIP_DUPLICATE", None), "b.csv": ("LOAD", 2),
                   "c.csv": ("LOAD", 1), "d.csv": ("SKIP_DUPLICATE", None)}
    # X11: forced pair reloads the same bytes as v+1.
    forced = _run(spark, root2, log=log.unionByName(second["log"]), forced=["12:2026-10-07"])
    got = {r["rel"].split("/")[-1]: (r["action"], r["file_version"]) for r in forced["plan"].collect()}
    assert got["a.csv"] == ("LOAD", 3) and got["b.csv"] == ("LOAD", 4)
    # dispositions
    disp = {r["rel"].split("/")[-1]: r["dest_path"] for r in second["disposition"].collect()}
    assert disp["b.csv"].startswith("processed/pedido/id_unidade=12/dt=2026-10-07/v2_")
    assert disp["a.csv"] == "processed/duplicates/20261008T060000_pedido__id_unidade=12__dt=2026-10-07__a.csv"


def test_scan_handles_readme_layout(spark, tmpdir_path):
    from strata.sources.landing import scan_landing
    _write(tmpdir_path, "raw/id_unidade=12/dt=2026-10-07/pedido.csv", HDR_P + "\n")
    _write(tmpdir_path, "raw/id_unidade=12/dt=2026-10-07/other.csv", HDR_P + "\n")
    valid, invalid = scan_landing(spark, tmpdir_path)
    assert [(r["tipo"], r["id_unidade"], r["data_ref"]) for r in valid.collect()] == \
        [("pedido", 12, dt.date(2026, 10, 7))]
    assert invalid.count() == 1


def test_one_unreadable_file_does_not_end_the_batch(spark, tmpdir_path):
    root, p = tmpdir_path, "incoming/pedido/id_unidade="
    good = HDR_P + "\n12;1;Loja Online;07/10/2026;1;;;Pendente\n"
    _write(root, p + "12/dt=2026-10-07/good.csv", good)
    _write(root, p + "13/dt=2026-10-07/cr.csv", HDR_P + "\n13;1;Loja\rOnline;07/10/2026;1;;;Pendente\n")
    _write(root, p + "14/dt=2026-10-07/long.csv",
           HDR_P + f"\n14;1;Loja Online;07/10/2026;1;{'x' * 140_000};;Pendente\n")
    _write(root, p + "15/dt=2026-10-07/wide.csv", HDR_P + "\n15;1\n" * 30)
    _write(root, "processed/pedido/id_unidade=12/dt=2026-10-07/v1_a_good.csv", good)
    _write(root, "rejected/x/incoming/bad.csv", good)
    _write(root, "incoming/pedido/nowhere.csv", good)
    out = _run(spark, root)
    names = {r["path"].rsplit("/", 1)[1]: r["action"] for r in out["plan"].collect()}
    assert names == {"good.csv": "LOAD", "cr.csv": "ERROR", "long.csv": "LOAD", "wide.csv": "REJECT"}
    assert {r["Id_Unidade"] for r in out["raw"]["pedido"].collect()} == {"12", "14"}
    log = {r["file_path"].rsplit("/", 1)[1]: (r["status"], r["error"]) for r in out["log"].collect() if r["status"] != "STARTED"}
    assert log["cr.csv"][0] == "ERROR" and log["cr.csv"][1]
    assert log["nowhere.csv"][0] == "REJECTED" and len(log) == 5          # nothing of processed/ or rejected/
    dest = {r["path"].rsplit("/", 1)[1]: r["dest_path"] for r in out["disposition"].collect()}
    assert dest["nowhere.csv"] == "rejected/20261008T060000/incoming/pedido/nowhere.csv"


def test_every_unit_is_reported(spark, tmpdir_path):
    rows = "".join(f"{u};{u};Loja Online;07/10/2026;1;;;Pendente\n" for u in range(100, 2600))
    _write(tmpdir_path, "incoming/pedido/id_unidade=12/dt=2026-10-07/u.csv", HDR_P + "\n" + rows)
    message = _run(spark, tmpdir_path)["plan"].first()["errors"][0]
    assert all(f"'{u}'" in message for u in (100, 1500, 2599))


def test_errors_are_counted_in_full(spark):
    from strata.sources.landing import validate_files
    text = HDR_P + "\n" + "1;2\n" * 50
    df = spark.createDataFrame([("p", "pedido", 1, text)], "path string, tipo string, id_unidade long, text string")
    r = validate_files(df)[0].first()
    assert r["n_errors"] == 50 and len(r["errors"]) == schemas.MAX_ERRORS_PER_FILE


def test_details_are_valid_json(spark):
    import json
    from strata.sources.landing import json_list
    values = ["a\u0001b", 'q"uo\\te', "né\n\t"]
    got = spark.createDataFrame([(values,)], "a array<string>").select(json_list(F.col("a"))).first()[0]
    assert json.loads(got) == values and "é" in got


def test_commit_survives_crash_and_replay(spark, tmpdir_path):
    root, base = tmpdir_path + "/in", tmpdir_path + "/out"
    _write(root, "incoming/pedido/id_unidade=12/dt=2026-10-07/a.csv", HDR_P + "\n12;1;Loja Online;07/10/2026;1;;;Pendente\n")
    out = _run(spark, root)
    for step in I.commit_steps(out, base, "batch1")[:2]:                 # cut off before the outcomes
        step()
    for _ in range(2):
        I.commit_batch(out, base, "batch1")
    assert I.committed(spark, base, "pedido").count() == 1
    assert I.folded_log(I.stored_log(spark, base)).count() == 1


@pytest.mark.parametrize("steps", [0, 1, 2, 3, 4, None])
def test_replanned_batch_loads_once(spark, tmpdir_path, steps):
    """A run that dies after any of its writes, its retries and the next batch, each planned from the stored log."""
    root, base = tmpdir_path + "/in", tmpdir_path + "/out"
    _write(root, "incoming/pedido/id_unidade=12/dt=2026-10-07/a.csv", HDR_P + "\n12;1;Loja Online;07/10/2026;1;;;Pendente\n")
    _write(root, "incoming/pedido/id_unidade=12/dt=2026-10-07/bad.csv", "x;y\n1;2\n")
    for batch, until in (("b1", steps), ("b1", None), ("b1", None), ("b2", None)):
        out = I.landing_batch(spark, root, I.stored_log(spark, base), batch, TS)
        for step in I.commit_steps(out, base, batch)[:until]:
            step()
    rows = I.committed(spark, base, "pedido").collect()
    assert [(r["Id_Pedido"], r["_file_version"]) for r in rows] == [("1", 1)]
    log = I.folded_log(I.stored_log(spark, base)).collect()
    assert [r["row_count"] for r in log if r["status"] == "LOADED"] == [1]
    assert not [r for r in log if r["status"] == "STARTED"]
    assert sorted(r["batch_id"] for r in I.quarantined(spark, base).collect()) == ["b1", "b2"]


def test_small_files_share_a_batch_of_records_and_long_ones_are_cut(monkeypatch):
    import pyarrow as pa

    from strata.sources import landing as L
    cols = ["path", "tipo", "id_unidade", "is_empty", "text", "delimiter"]
    rows = [("a", "pedido", 1, False, "x;y\n1;2\n", ";"), ("b", "pedido", 2, True, None, ";"), ("c", "pedido", 3, False, "z\n\"1\n2\"\n", ";")]
    batch = pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate(cols)})
    (out,) = L._split_batches([batch])
    got = [(r["path"], r["record_no"], r["cells"]) for r in out.to_pylist()]
    assert got == [("a", 0, ["pedido", "1", "False"]), ("a", 1, ["x", "y"]), ("a", 2, ["1", "2"]), ("b", 0, ["pedido", "2", "True"]),
                   ("c", 0, ["pedido", "3", "False"]), ("c", 1, ["z"]), ("c", 2, ["1\n2"])]
    monkeypatch.setattr(L, "CHUNK_CELLS", 4)
    cut = list(L._split_batches([batch]))
    assert len(cut) > 1 and [r for b in cut for r in b.to_pylist()] == out.to_pylist()


def test_contents_are_not_joined(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "incoming/pedido/id_unidade=1/dt=2026-01-01")
    os.makedirs(folder)
    for name, data in (("a.csv", b"x"), ("b.csv", b"")):
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)
    from strata.sources.landing import scan_landing
    valid, _ = scan_landing(spark, tmpdir_path)
    assert sorted((os.path.basename(r["path"]), bytes(r["content"])) for r in valid.collect()) == [("a.csv", b"x"), ("b.csv", b"")]
    plan = valid.select("path", "content")._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"                 # the join with the listing is below, over names only


def test_rows_of_an_attempt_are_written_where_they_are(spark, tmpdir_path):
    from strata.sinks import storage
    rows = spark.range(0, 100, 1, 4).withColumn("_batch", F.lit("b"))
    storage.append(rows, tmpdir_path, ["_batch"], spread=True)
    back = spark.read.parquet(tmpdir_path)
    assert back.count() == 100 and len(back.inputFiles()) == 4


def test_files_are_read_by_lines_and_never_whole(spark, tmpdir_path):
    """A batch reads no content as one value, and a file longer than a partition still belongs to one task, in order."""
    import hashlib
    root, p = tmpdir_path, "incoming/pedido/id_unidade="
    body = HDR_P + "\n" + "".join(f"12;{i};Loja Online;07/10/2026;1;;;Pendente\n" for i in range(3000))
    _write(root, p + "12/dt=2026-10-07/a.csv", body)
    confs = {"spark.sql.sources.binaryFile.maxLength": "100", "spark.sql.files.maxPartitionBytes": "4k",
             "spark.sql.files.openCostInBytes": "1k"}
    old = {c: spark.conf.get(c) for c in confs}
    try:
        for c, v in confs.items():
            spark.conf.set(c, v)
        out = _run(spark, root)
        (plan,) = out["plan"].collect()
        assert plan["file_hash"] == hashlib.sha256(body.encode()).hexdigest() and plan["action"] == "LOAD"
        rows = out["raw"]["pedido"].select("_line_no", "Id_Pedido").collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sorted(map(tuple, rows)) == [(i + 2, str(i)) for i in range(3000)]


def test_lines_give_what_whole_texts_give(spark, tmpdir_path, monkeypatch):
    import csv
    import hashlib
    import io

    from strata.sources import landing as L
    bom, h = L.BOM, HDR_I.encode()
    files = [h + b"\n1;2\n", h + b"\n1;2", h + b"\r\n1;2\r\n", bom + h + b"\n1;2\n", bom + h + b"\n\xe9;2", bom, bom + b"\n", bom + bom + h,
             b"", b"\n", b"\n\n", b" \t\n\xc2\xa0", b"\xa0\n", b"\xe9", h + b'\n1;"a\n\nb', h + b'\n1;"a\n\nb\n', h + b'\n"\xe9\n";\xc3\xa9\n',
             h + b"\n1;2\r3\n4;5\n", "a|b,c|d\n1|2\n".encode(), h + b"\n\x00;1\n", h + "\n1; x\n".encode()]
    for i, data in enumerate(files):
        _write(tmpdir_path, f"incoming/item_pedido/id_unidade={i + 1}/dt=2026-10-07/f.csv", data)
    stored = []
    monkeypatch.setattr(L, "split_lines", lambda *a, f=L.split_lines: stored.append(f(*a)) or stored[-1])
    monkeypatch.setattr(L, "CHUNK_ROWS", 2)
    plan = {r["id_unidade"]: r for r in _run(spark, tmpdir_path)["plan"].collect()}
    got = {}
    for r in sorted(stored[0].collect(), key=lambda r: r["record_no"] if r["record_no"] > 0 else 1 << 30):
        got.setdefault(int(r["path"].split("id_unidade=")[1].split("/")[0]), []).append((r["record_no"], r["cells"]))
    valid, _ = L.scan_landing(spark, tmpdir_path)
    texts = L.decode_text(valid).withColumn("delimiter", L.detect_delimiter(F.col("text"))).collect()
    assert len(texts) == len(files) == len(plan)
    for r in texts:
        unit, data = r["id_unidade"], files[r["id_unidade"] - 1]
        assert plan[unit]["file_hash"] == r["file_hash"] == hashlib.sha256(data).hexdigest(), data
        want, no = [], 0
        try:
            for no, row in enumerate(csv.reader(io.StringIO(r["text"]), delimiter=r["delimiter"]), 1):
                want.append((no, row))
        except csv.Error as ex:
            want.append((L.READ_ERROR, [str(ex)]))
        empty_text = not r["text"].strip(L.C.WHITE_SPACE)
        assert got.get(unit, []) == ([] if empty_text else want), data
        assert (plan[unit]["errors"] == ["arquivo vazio"]) == empty_text, data

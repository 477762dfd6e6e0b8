"""The landing stream against the batch planner: waves of files in random order, a restart after each, empty files."""

import os
import random

from pyspark.sql import functions as F

from strata import schemas
from strata.plans import ingest as I
from strata.sources.landing import scan_landing
from strata.sources.tables import empty
from strata.streaming.ingest import check_files, check_stream, plan_stream

HDR = "Id_Unidade;Id_Pedido;Tipo_Pedido;Data_Pedido;Vlr_Pedido;Endereco_Entrega;Taxa_Entrega;Status\n"


def test_stream_decides_like_the_batch_planner(spark, tmpdir_path):
    rnd = random.Random(4)
    root, checked, planned = (f"{tmpdir_path}/{n}" for n in ("in", "checked", "planned"))
    log, want, serial = empty(spark, schemas.INGESTION_LOG_SCHEMA), {}, 0
    for wave in range(3):
        for _ in range(9):
            unit, day, kind = rnd.choice([1, 2]), rnd.choice(["2026-01-01", "2026-01-02"]), rnd.randrange(6)
            body = {0: "", 1: "x;y\n1;2\n"}.get(kind, HDR + f"{unit};{rnd.randrange(4)};Loja Online;{day};1;;;Pendente\n")
            serial += 1
            folder = f"{root}/incoming/pedido/id_unidade={unit}/dt={day}"
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/f{rnd.randrange(100):02d}_{serial}.csv", "w") as fh:
                fh.write(body)
        check_stream(spark, root, f"{tmpdir_path}/c1", checked)
        plan_stream(spark, checked, f"{tmpdir_path}/c2", planned)
        new = check_files(scan_landing(spark, root)[0]).filter(~F.col("path").isin(list(want)))
        plan = I.plan_files(new, log).collect()
        want |= {r["path"]: (r["action"], r["file_version"]) for r in plan}
        loads = [(r["path"], r["file_hash"], r["id_unidade"], r["tipo"], r["data_ref"], r["file_version"], None, "LOADED", "b",
                  None, r["data_ref"]) for r in plan if r["action"] == "LOAD"]
        rows = spark.createDataFrame(loads, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.INGESTION_LOG_SCHEMA)
                                     .replace("processed_at timestamp", "processed_at date"))
        log = log.unionByName(rows.withColumn("processed_at", F.col("processed_at").cast("timestamp")))
    plan_stream(spark, checked, f"{tmpdir_path}/c2", planned)            # nothing new
    got = {r["path"]: (r["action"], r["file_version"]) for r in spark.read.parquet(planned).collect()}
    assert got == want and len(want) == 27
    assert {a for a, _ in got.values()} == {"LOAD", "SKIP_DUPLICATE", "REJECT"}

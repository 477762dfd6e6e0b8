"""The set-based plan equals a literal serial run of the per-file rule."""

import datetime as dt
import random

from strata.plans.ingest import plan_files


def serial(files, log, forced):
    """The reference loop: files in (date, unit, type) order, stable on path."""
    loaded = [(r[0], r[1], r[3], r[4]) for r in log]          # unit, tipo, hash, version ... per date below
    hashes = {(u, t, h) for (u, t, d, h, v) in log}
    versions = {}
    for (u, t, d, h, v) in log:
        versions[(u, t, d)] = max(versions.get((u, t, d), 0), v)
    out = {}
    for f in sorted(files, key=lambda f: (f["data_ref"], f["id_unidade"], f["tipo"], f["path"])):
        key = (f["id_unidade"], f["tipo"], f["file_hash"])
        is_forced = (f["id_unidade"], f["data_ref"]) in forced
        if key in hashes and not is_forced:
            out[f["path"]] = ("SKIP_DUPLICATE", None)
            continue
        if not f["valid"]:
            out[f["path"]] = ("REJECT", None)
            continue
        vk = (f["id_unidade"], f["tipo"], f["data_ref"])
        v = versions.get(vk, 0) + 1
        versions[vk] = v
        hashes.add(key)
        out[f["path"]] = ("LOAD", v)
    del loaded
    return out


def test_closed_form_matches_serial(spark):
    rnd = random.Random(42)
    days = [dt.date(2026, 10, d) for d in (5, 6, 7)]
    for trial in range(6):
        # validity is a function of the bytes (and the unit/type contract)
        validity = {(u, t, h): rnd.random() > 0.25 for u in (1, 2) for t in ("pedido", "item_pedido")
                    for h in "abcd"}
        files = []
        for n in range(rnd.randint(5, 25)):
            u, t, d = rnd.choice([1, 2]), rnd.choice(["pedido", "item_pedido"]), rnd.choice(days)
            h = rnd.choice("abcd")
            files.append({"path": f"incoming/{t}/id_unidade={u}/dt={d}/f{n:02d}.csv", "id_unidade": u, "tipo": t,
                          "data_ref": d, "file_hash": h, "valid": validity[(u, t, h)]})
        log = [(rnd.choice([1, 2]), rnd.choice(["pedido", "item_pedido"]), rnd.choice(days), rnd.choice("abcd"),
                rnd.randint(1, 3)) for _ in range(rnd.randint(0, 6))]
        forced = {(1, days[2])} if trial % 2 else set()
        fdf = spark.createDataFrame(files, "path string, id_unidade long, tipo string, data_ref date, "
                                           "file_hash string, valid boolean")
        ldf = spark.createDataFrame([(u, t, d, h, v, "LOADED") for (u, t, d, h, v) in log],
                                    "id_unidade long, tipo string, data_ref date, file_hash string, "
                                    "file_version long, status string")
        fr = spark.createDataFrame(sorted(forced), "id_unidade long, data_ref date") if forced else None
        got = {r["path"]: (r["action"], r["file_version"]) for r in plan_files(fdf, ldf, fr).collect()}
        assert got == serial(files, log, forced), f"trial {trial}"

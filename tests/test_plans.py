"""Plan-shape tests and an entry/oracle smoke test on sf0.001."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from strata.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_to_gold_has_no_python(spark):
    plan = _plan(E.q_gold_vendas_diarias(spark, SF))
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_dedup_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in _plan(E.q_bronze_item_dedup(spark, SF))


def test_scans_are_pruned(spark):
    schemas = [x.split("\n")[0] for x in _plan(E.q_parse_date_br(spark, SF)).split("ReadSchema")[1:]]
    assert schemas and not any(c in s for s in schemas for c in ("o_totalprice", "o_comment", "o_clerk"))


def test_lookback_filter_reaches_the_items(spark):
    """The incremental run joins items to the window's orders before it adds them up."""
    plan = _plan(E.q_lookback_filter(spark, SF))
    assert "LeftSemi" in plan and plan.index("LeftSemi") > plan.index("LeftOuter")


def test_a_single_day_is_written_by_several_tasks(spark, tmpdir_path):
    import glob
    from pyspark.sql import functions as F
    from strata.sinks import storage
    df = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        storage.replace_snapshot(df, tmpdir_path + "/t", dt.date(2024, 1, 1), "b", dt.datetime(2024, 1, 1))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(tmpdir_path + "/t/_snapshot_date=2024-01-01/*.parquet")) > 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ticket_medio" in df.columns


@pytest.mark.parametrize("name", ["gold_vendas_diarias", "consumo_7d_28d", "completeness", "idempotency_plan",
                                  "merge_upsert", "disposition"])
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)

    def norm(cols, rows):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        out = []
        for r in rows:
            vals = []
            for i in idx:
                v = r[i]
                if isinstance(v, dt.datetime):
                    v = v.isoformat()
                elif isinstance(v, dt.date):
                    v = v.isoformat()
                vals.append(repr(v))
            out.append(tuple(vals))
        return sorted(out)
    assert norm(sdf.columns, [tuple(r) for r in sdf.collect()]) == norm(dcols, cur.fetchall())

"""Landing -> raw as one set-based batch: idempotency plan (I1, W4, W5, A6,
A7), lineage (K1, K2), log and quarantine rows (K5, K6), file disposition
(K7) and the run summary (A9)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.operators.dedup import dedup_latest
from strata.sources.landing import json_list

HASH_SCOPE = ("id_unidade", "tipo")


def loaded_hashes(log: DataFrame, scope: Sequence[str] = HASH_SCOPE) -> DataFrame:
    """(scope, hash) pairs already LOADED (not by date, by default)."""
    return (log.filter(F.col("status") == "LOADED").select(*scope, "file_hash").distinct()
               .withColumn("_seen", F.lit(True)))


def max_loaded_versions(log: DataFrame) -> DataFrame:
    """Newest LOADED version per (unit, type, date)."""
    return (log.filter(F.col("status") == "LOADED").groupBy("id_unidade", "tipo", "data_ref")
               .agg(F.max("file_version").alias("_max_version")))


def forced_pairs(spark, pairs: Sequence[str]) -> DataFrame | None:
    """``["12:2026-10-07", ...]`` -> (id_unidade, data_ref)."""
    if not pairs:
        return None
    rows = [(int(p.split(":")[0]), dt.date.fromisoformat(p.split(":")[1])) for p in pairs]
    return spark.createDataFrame(rows, "id_unidade bigint, data_ref date")


def plan_files(files: DataFrame, log: DataFrame, forced: DataFrame | None = None,
               hash_scope: Sequence[str] = HASH_SCOPE) -> DataFrame:
    """The closed form of the serial per-file loop.

    ``files``: path, id_unidade, tipo, data_ref, file_hash, valid.
    A file is SKIP_DUPLICATE when its hash is already LOADED in its scope
    (unless forced) or an earlier valid file of the batch (by date, path)
    carries it; an invalid file is REJECT; the rest LOAD, numbered after the
    newest loaded version of (unit, type, date) in path order.

    The first-of-hash test is an aggregate (``min`` of (date, path) per hash,
    partially aggregated before the shuffle), so a hot hash cannot pile up in
    one window partition.
    """
    scope = list(hash_scope)
    m = files.join(loaded_hashes(log, scope), [*scope, "file_hash"], "left")
    if forced is not None:
        m = m.join(forced.select("id_unidade", "data_ref").distinct().withColumn("_forced", F.lit(True)),
                   ["id_unidade", "data_ref"], "left")
    else:
        m = m.withColumn("_forced", F.lit(None).cast("boolean"))
    seen = F.coalesce(F.col("_seen"), F.lit(False))
    forced_c = F.coalesce(F.col("_forced"), F.lit(False))
    m = m.withColumns({"_seen": seen, "_forced": forced_c})
    cand = m.filter(F.col("valid") & ~F.col("_seen"))
    first = cand.groupBy(*scope, "file_hash").agg(F.min(F.struct("data_ref", "path"))["path"].alias("_first"))
    m = m.join(first, [*scope, "file_hash"], "left")
    failed = F.col("read_error").isNotNull() if "read_error" in m.columns else F.lit(False)
    action = (F.when(F.col("_seen") & ~F.col("_forced"), F.lit("SKIP_DUPLICATE"))
               .when(failed, F.lit("ERROR"))
               .when(~F.col("valid"), F.lit("REJECT"))
               .when(F.col("_forced") | (F.col("path") == F.col("_first")), F.lit("LOAD"))
               .otherwise(F.lit("SKIP_DUPLICATE")))
    m = m.withColumn("action", action)
    m = m.join(max_loaded_versions(log), ["id_unidade", "tipo", "data_ref"], "left")
    is_load = F.col("action") == "LOAD"
    # only LOAD rows are numbered; the others are spread over window partitions of their own
    spread = F.when(~is_load, F.xxhash64("path"))
    w = Window.partitionBy("id_unidade", "tipo", "data_ref", spread).orderBy("path")
    version = F.when(is_load, F.coalesce(F.col("_max_version"), F.lit(0)) + F.row_number().over(w))
    return m.withColumn("file_version", version.cast("bigint")).drop("_seen", "_forced", "_first", "_max_version")


def final_status(action: Column) -> Column:
    return (F.when(action == "LOAD", F.lit("LOADED")).when(action == "SKIP_DUPLICATE", F.lit("SKIPPED_DUPLICATE"))
             .when(action == "REJECT", F.lit("REJECTED")).otherwise(F.lit("ERROR")))


def load_id(plan: DataFrame) -> Column:
    """K2: ``load_{tipo}_{unit}_{yyyymmdd}_{hash12}_v{n}`` (deterministic)."""
    return F.concat(F.lit("load_"), F.col("tipo"), F.lit("_"), F.col("id_unidade").cast("string"), F.lit("_"),
                    F.date_format("data_ref", "yyyyMMdd"), F.lit("_"), F.substring("file_hash", 1, 12),
                    F.lit("_v"), F.col("file_version").cast("string"))


def disposition(plan: DataFrame, batch_ts: dt.datetime, prefix: str = "incoming/") -> DataFrame:
    """K7: destination of every file by outcome."""
    rel = F.when(F.col("rel").startswith(prefix), F.substring("rel", len(prefix) + 1, 1 << 20)) \
        .otherwise(F.col("rel"))
    stamp = F.lit(batch_ts.strftime("%Y%m%dT%H%M%S"))
    folder = F.regexp_extract(rel, r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract(rel, r"([^/]*)$", 1)
    dest = (F.when(F.col("action") == "LOAD",
                   F.concat(F.lit("processed/"), folder, F.lit("/v"), F.col("file_version").cast("string"),
                            F.lit("_"), F.substring("file_hash", 1, 8), F.lit("_"), name))
             .when(F.col("action") == "SKIP_DUPLICATE",
                   F.concat(F.lit("processed/duplicates/"), stamp, F.lit("_"), F.replace(rel, F.lit("/"), F.lit("__"))))
             .otherwise(F.concat(F.lit("rejected/"), stamp, F.lit("/"), rel)))
    return plan.withColumn("dest_path", dest)


def log_events(plan: DataFrame, batch_id: str, batch_ts: dt.datetime, row_counts: DataFrame | None = None,
               invalid_names: DataFrame | None = None) -> DataFrame:
    """K5: ingestion-log rows: LOAD -> STARTED + LOADED(row_count), skip ->
    SKIPPED_DUPLICATE, invalid -> REJECTED (messages joined, cut to 1000)."""
    p = plan
    if row_counts is not None:
        p = p.join(row_counts, "path", "left")
    else:
        p = p.withColumn("row_count", F.lit(None).cast("bigint"))
    statuses = (F.when(F.col("action") == "LOAD", F.array(F.lit("STARTED"), F.lit("LOADED")))
                 .when(F.col("action") == "SKIP_DUPLICATE", F.array(F.lit("SKIPPED_DUPLICATE")))
                 .when(F.col("action") == "ERROR", F.array(F.lit("ERROR")))
                 .otherwise(F.array(F.lit("REJECTED"))))
    errs = F.col("errors") if "errors" in p.columns else F.array().cast("array<string>")
    ev = p.select("path", "file_hash", "id_unidade", "tipo", "data_ref", "file_version", "row_count", "action",
                  errs.alias("errors"), F.explode(statuses).alias("status"))
    out = ev.select(
        F.col("path").alias("file_path"), "file_hash", "id_unidade", "tipo", "data_ref",
        F.when(F.col("status").isin("STARTED", "LOADED"), F.col("file_version")).alias("file_version"),
        F.when(F.col("status") == "LOADED", F.coalesce(F.col("row_count"), F.lit(0).cast("bigint")))
         .alias("row_count"),
        "status", F.lit(batch_id).alias("batch_id"),
        F.when(F.col("status").isin("REJECTED", "ERROR"),
               F.substring(F.array_join("errors", "; "), 1, schemas.LOG_ERROR_CHARS)).alias("error"),
        F.lit(batch_ts).alias("processed_at"))
    if invalid_names is not None:
        bad = invalid_names.select(
            F.col("path").alias("file_path"), F.lit(None).cast("string").alias("file_hash"),
            F.lit(None).cast("bigint").alias("id_unidade"), F.lit(None).cast("string").alias("tipo"),
            F.lit(None).cast("date").alias("data_ref"), F.lit(None).cast("bigint").alias("file_version"),
            F.lit(None).cast("bigint").alias("row_count"), F.lit("REJECTED").alias("status"),
            F.lit(batch_id).alias("batch_id"), F.lit(schemas.MSG_BAD_NAME).alias("error"),
            F.lit(batch_ts).alias("processed_at"))
        out = out.unionByName(bad)
    return out


def quarantine_rows(plan: DataFrame, batch_id: str, batch_ts: dt.datetime,
                    invalid_names: DataFrame | None = None) -> DataFrame:
    """K6: rejected files with reason and JSON details (cut to 5000)."""
    rej = plan.filter(F.col("action") == "REJECT").select(
        F.col("path").alias("file_path"), "file_hash", "id_unidade", "tipo", "data_ref",
        F.lit(schemas.REASON_INVALID).alias("reason"),
        F.substring(json_list(F.col("errors")), 1, schemas.QUARANTINE_DETAIL_CHARS).alias("details"),
        F.lit(batch_id).alias("batch_id"), F.lit(batch_ts).alias("quarantined_at"))
    if invalid_names is not None:
        bad = invalid_names.select(
            F.col("path").alias("file_path"), F.lit(None).cast("string").alias("file_hash"),
            F.lit(None).cast("bigint").alias("id_unidade"), F.lit(None).cast("string").alias("tipo"),
            F.lit(None).cast("date").alias("data_ref"), F.lit(schemas.REASON_BAD_NAME).alias("reason"),
            F.substring(json_list(F.array(F.col("rel"))), 1, schemas.QUARANTINE_DETAIL_CHARS).alias("details"),
            F.lit(batch_id).alias("batch_id"), F.lit(batch_ts).alias("quarantined_at"))
        rej = rej.unionByName(bad)
    return rej


def with_lineage(rows: DataFrame, plan: DataFrame, batch_id: str, batch_ts: dt.datetime,
                 source_prefix: str = "") -> DataFrame:
    """K1 + K2: contract rows of LOAD files with the lineage columns."""
    loads = plan.filter(F.col("action") == "LOAD").select(
        "path", F.col("rel").alias("_p_rel"), F.col("file_hash").alias("_p_hash"),
        F.col("file_version").alias("_p_version"), F.col("id_unidade").alias("_p_unit"),
        load_id(plan).alias("_load_id"))
    j = rows.join(loads, "path", "inner")
    return j.withColumns({
        "_ingestion_ts": F.lit(batch_ts),
        "_source_file": F.concat(F.lit(source_prefix), F.col("_p_rel")),
        "_file_hash": F.col("_p_hash"),
        "_file_version": F.col("_p_version"),
        "_id_unidade": F.col("_p_unit").cast("string"),
        "_batch_id": F.lit(batch_id),
        "_line_no": F.col("record_no"),
    }).drop("path", "_p_rel", "_p_hash", "_p_version", "_p_unit", "record_no")


def run_summary(plan: DataFrame, invalid_names: DataFrame | None = None) -> DataFrame:
    """Files per final status, sorted by status."""
    st = plan.select(final_status(F.col("action")).alias("status"))
    if invalid_names is not None:
        st = st.unionByName(invalid_names.select(F.lit("REJECTED").alias("status")))
    return st.groupBy("status").agg(F.count(F.lit(1)).alias("n_files")).orderBy("status")


def landing_batch(spark, root: str, log: DataFrame, batch_id: str, batch_ts: dt.datetime,
                  forced: Sequence[str] = (), data_ref=None, hash_scope: Sequence[str] = HASH_SCOPE,
                  source_prefix: str = "") -> dict[str, DataFrame]:
    """One landing run as DataFrames: plan, raw rows per type, log and
    quarantine rows, dispositions and the summary.  Nothing is written here;
    ``commit_batch`` writes them in the order that makes a replay harmless."""
    from strata.sources.landing import (BOM, contract_rows, detect_delimiter, file_lines, measure_files, scan_names,
                                        split_lines, validate_records)

    from strata.session import scratch_path

    def materialize(df: DataFrame) -> DataFrame:
        # The files are read and parsed once, into a table in the shared
        # folder: every later output reuses it and a lost executor never
        # re-runs the parse (lineage is cut at the written table).  Of the
        # tables with a row per file Spark knows the size, so records are
        # joined with them where they lie as long as they are small.
        path = scratch_path(spark, f"landing-records-{batch_id}")
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    found, invalid = scan_names(spark, root, data_ref)
    found = materialize(found)
    uris = [r["uri"] for r in found.select("uri").filter("uri is not null").collect()]
    measured = materialize(measure_files(file_lines(spark, root, uris)))
    # a file without a line is empty or a BOM alone
    bare = F.when(F.col("length") == 0, F.sha2(F.lit(b"").cast("binary"), 256)).otherwise(F.sha2(F.lit(BOM).cast("binary"), 256))
    valid = materialize(found.join(measured, "uri", "left").withColumns({
        "file_hash": F.coalesce("file_hash", bare), "is_empty": F.coalesce("is_empty", F.lit(True)),
        "delimiter": detect_delimiter(F.coalesce("header", F.lit("")))}).drop("header"))
    pairs = forced_pairs(spark, forced)
    # a file whose content is already loaded is skipped whatever it holds, so only the others are decoded and parsed
    seen = loaded_hashes(log, hash_scope).drop("_seen")
    todo = valid.join(seen, [*hash_scope, "file_hash"], "left_anti")
    if pairs is not None:
        again = valid.join(pairs, ["id_unidade", "data_ref"], "left_semi").join(seen, [*hash_scope, "file_hash"], "left_semi")
        todo = todo.unionByName(again.select(*todo.columns))
    todo = materialize(todo.select("path", "uri", "tipo", "id_unidade", "is_empty", "utf8", "bom", "ended", "n_lines", "delimiter"))
    parsed = {r[0]: tuple(r[1:]) for r in todo.filter(~F.col("is_empty")).select(
        "uri", "path", "utf8", "bom", "ended", "n_lines", "delimiter").collect()}
    recs = materialize(split_lines(file_lines(spark, root, list(parsed)), parsed))
    errors, records = validate_records(recs, todo.select("path", "tipo", "id_unidade", "is_empty"), materialize=materialize)
    files = valid.join(errors, "path", "left").withColumn(
        "valid", F.coalesce(F.size("errors") == 0, F.lit(False)))
    plan = materialize(plan_files(files.select("path", "rel", "id_unidade", "tipo", "data_ref", "file_hash", "valid",
                                               "errors", "read_error"),
                                  log, pairs, hash_scope))
    counts = materialize(records.groupBy("path").agg(F.count(F.lit(1)).alias("row_count")))
    raw = {}
    for tipo in schemas.EXPECTED_COLUMNS:
        rows = contract_rows(records.join(plan.filter((F.col("tipo") == tipo) & (F.col("action") == "LOAD"))
                                          .select("path"), "path", "left_semi"), tipo)
        raw[tipo] = with_lineage(rows, plan, batch_id, batch_ts, source_prefix)
    return {
        "plan": plan,
        "raw": raw,
        "log": log_events(plan, batch_id, batch_ts, counts, invalid),
        "quarantine": quarantine_rows(plan, batch_id, batch_ts, invalid),
        "disposition": disposition(plan, batch_ts).select("path", "rel", "action", "dest_path").unionByName(
            invalid.select("path", "rel", F.lit("REJECT").alias("action"),
                           F.concat(F.lit(f"rejected/{batch_ts:%Y%m%dT%H%M%S}/"), F.col("rel")).alias("dest_path"))),
        "summary": run_summary(plan, invalid),
    }


LOG_STEPS = {"ERROR": 1, "REJECTED": 1, "SKIPPED_DUPLICATE": 1, "LOADED": 2}      # how far a file got; STARTED is 0


def stored_log(spark, base: str) -> DataFrame:
    """Every event ever appended (K5), with the load id and attempt it belongs to; empty before the first batch."""
    return _stored(spark, f"{base}/log", schemas.INGESTION_LOG_SCHEMA, "_load_id", "_batch", "_attempt")


def _stored(spark, path: str, schema: T.StructType, *more: str) -> DataFrame:
    """A table of this module by its declared schema; empty if nothing was written yet."""
    full = T.StructType([*schema, *[T.StructField(c, T.StringType()) for c in more]])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def folded_log(events: DataFrame) -> DataFrame:
    """One row per load id, its furthest state (the first attempt that got there); other files once per outcome.

    A later attempt adds events and never takes one away, so a file that was loaded stays loaded whatever a retry of its
    batch decides.
    """
    other = F.concat_ws("|", "file_path", "file_hash", "batch_id", "status")
    step = F.lit(0)
    for status, far in LOG_STEPS.items():
        step = F.when(F.col("status") == status, F.lit(far)).otherwise(step)
    keyed = events.withColumns({"_key": F.coalesce("_load_id", other), "_step": step})
    first = dedup_latest(keyed, ["_key"], [F.col("_step").desc(), F.col("processed_at").asc(), F.col("_attempt").asc()])
    return first.drop("_key", "_step")


def commit_steps(out: dict[str, DataFrame], base: str, batch_id: str, attempt: str | None = None) -> list:
    """K1, K2, K5, K6: the writes of a batch, in order; nothing is ever overwritten.

    STARTED events, raw rows, quarantine, then the outcomes.  Raw rows and quarantine carry the attempt that wrote them;
    readers (``committed``, ``quarantined``) take those of the attempt whose outcome counts in the folded log, so what a
    dead attempt left is never seen, and a batch that is planned again finds its files loaded.
    """
    from strata.sinks import storage
    attempt = attempt or uuid.uuid4().hex[:12]
    mark = {"_batch": F.lit(batch_id), "_attempt": F.lit(attempt)}
    loads = out["plan"].filter(F.col("action") == "LOAD").select(
        F.col("path").alias("file_path"), load_id(out["plan"]).alias("_load_id"))
    log = out["log"].join(loads, "file_path", "left").withColumns(mark)
    started = F.col("status") == "STARTED"
    by = ["_batch", "_attempt"]
    steps = [lambda: storage.append(log.filter(started), f"{base}/log", by)]
    for tipo, rows in out["raw"].items():
        # an attempt's rows are one partition: nothing to bring together, every task writes what it read
        steps.append(lambda t=tipo, r=rows: storage.append(r.withColumns(mark), f"{base}/raw_{t}", by, spread=True))
    steps.append(lambda: storage.append(out["quarantine"].withColumns(mark), f"{base}/quarantine", by))
    steps.append(lambda: storage.append(log.filter(~started), f"{base}/log", by))
    return steps


def commit_batch(out: dict[str, DataFrame], base: str, batch_id: str, attempt: str | None = None) -> None:
    for step in commit_steps(out, base, batch_id, attempt):
        step()


def _of_outcome(spark, base: str, rows: DataFrame, status: str, key: str) -> DataFrame:
    done = folded_log(stored_log(spark, base)).filter(F.col("status") == status).select(key, "_attempt").distinct()
    return rows.join(done, [key, "_attempt"], "left_semi").drop("_batch", "_attempt")


def committed(spark, base: str, tipo: str) -> DataFrame:
    """Raw rows of one type: of every load, the attempt that the folded log has as LOADED."""
    rows = _stored(spark, f"{base}/raw_{tipo}", schemas.RAW_CSV_SCHEMAS[tipo], "_batch", "_attempt")
    return _of_outcome(spark, base, rows, "LOADED", "_load_id")


def quarantined(spark, base: str) -> DataFrame:
    """Quarantine rows, once per file and batch."""
    rows = _stored(spark, f"{base}/quarantine", schemas.QUARANTINE_SCHEMA, "_batch", "_attempt")
    return _of_outcome(spark, base, rows, "REJECTED", "file_path")

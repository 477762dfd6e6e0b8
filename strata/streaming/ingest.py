"""ST1 / ST2: the batch functions driven by Structured Streaming.

``Trigger.AvailableNow`` processes everything new since the last checkpoint
and stops, which is the daily-run shape; ``foreachBatch`` calls the same
batch functions as the batch path.  ``log_stream`` writes each micro-batch to
a partition named by its checkpoint and number and overwrites it there, so a
replayed micro-batch changes nothing; ``bronze_stream`` keeps the number of the
last finished micro-batch in the state of the table it merges into.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.plans import bronze as B
from strata.plans import stored
from strata.sinks import ranges, storage
from strata.sources.landing import decode_text, named_files, norm_path, scan_landing, validate_files


def run_available_now(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                      name: str | None = None) -> None:
    """Drive ``handler`` over every new input once, then stop."""
    w = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def log_stream(spark: SparkSession, source_dir: str, schema, to_log: Callable[[DataFrame], DataFrame],
               table: str, checkpoint: str, by=("_day",), glob: str = "*.parquet") -> None:
    """Stream parquet event files of a folder into a log table, one partition
    per micro-batch and day."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source_dir)

    run_available_now(stream, log_handler(to_log, table, checkpoint, by), checkpoint)


def log_handler(to_log: Callable[[DataFrame], DataFrame], table: str, checkpoint: str,
                by=("_day",)) -> Callable[[DataFrame, int], None]:
    """The handler of ``log_stream``: called twice for one epoch it writes the same partition twice."""
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, epoch: int) -> None:
        rows = to_log(batch).withColumns({"_day": F.to_date("processed_at"), "_batch": F.lit(f"{source}-{epoch}")})
        storage.replace_partitions(rows, table, ["_batch", *by])

    return handle


FILE = "path string, modificationTime timestamp, length long, content binary"
CHECKED = ("path string, rel string, id_unidade long, tipo string, data_ref date, file_hash string, valid boolean, "
           "errors array<string>, read_error string")
PLANNED = CHECKED + ", action string, file_version long"
UNIT_STATE = "hashes array<binary>, days array<date>, versions array<long>"


def check_handler(spark: SparkSession, root: str, checked: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """The handler of ``check_stream``: the new files of one micro-batch, decoded and validated."""
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, epoch: int) -> None:
        files = named_files(batch.select(norm_path(F.col("path")).alias("path"), "length", "content"), root)[0]
        storage.replace_partitions(check_files(files).withColumn("_batch", F.lit(f"{source}-{epoch:09d}")), checked, ["_batch"])

    return handle


def check_files(files: DataFrame) -> DataFrame:
    errors, _ = validate_files(decode_text(files).select("path", "tipo", "id_unidade", "text"),
                               materialize=lambda df: stored.kept(df, "checked-records"))
    out = files.join(errors, "path", "left").withColumn("valid", F.coalesce(F.size("errors") == 0, F.lit(False)))
    return out.select(*[c.split()[0] for c in CHECKED.split(", ")])


def check_stream(spark: SparkSession, root: str, checkpoint: str, checked: str, files_per_batch: int | None = None) -> None:
    """ST1, first half: landing files as a file stream into the table of checked files.

    The stream gives no row for a 0-byte file, so what the folder lists and the table lacks is checked once it ends.
    """
    reader = (spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.csv"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    run_available_now(reader.load(root.rstrip("/") + "/{incoming,raw}"), check_handler(spark, root, checked, checkpoint),
                      checkpoint)
    have = spark.read.schema(CHECKED).parquet(checked).select("path")
    late = scan_landing(spark, root)[0].join(have, "path", "left_anti")
    storage.append(check_files(late).withColumn("_batch", F.lit(f"listed-{uuid.uuid4().hex[:12]}")), checked, ["_batch"])


def plan_unit(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Files of one (unit, type) in the order of date and path, against the hashes and versions the state holds."""
    hashes, days, versions = state.get if state.exists else ([], [], [])
    seen, last = set(map(bytes, hashes)), dict(zip(days, versions))
    rows = pd.concat(list(frames)).sort_values(["data_ref", "path"], kind="stable")
    action, number = [], []
    for digest, valid, unread, day in zip(rows["file_hash"], rows["valid"], rows["read_error"], rows["data_ref"]):
        digest, version = bytes.fromhex(digest), None
        if digest in seen:
            what = "SKIP_DUPLICATE"
        elif unread is not None:
            what = "ERROR"
        elif not valid:
            what = "REJECT"
        else:
            what = "LOAD"
            seen.add(digest)
            version = last[day] = last.get(day, 0) + 1
        action.append(what)
        number.append(version)
    state.update((sorted(seen), list(last), list(last.values())))
    yield rows.assign(action=action, file_version=pd.array(number, "Int64"))


def plan_stream(spark: SparkSession, checked: str, checkpoint: str, planned: str, files_per_batch: int | None = None) -> None:
    """ST1, second half: checked files to load decisions (I1), with state instead of a log lookup.

    The state store holds, per (unit, type), the digests ever loaded and the newest version per date: a few bytes per file
    a unit ever sent.  A micro-batch decides what ``plan_files`` decides for the same files after the same history; its
    rows go to a partition of their own, so a replay writes the same partition again.
    """
    reader = spark.readStream.schema(CHECKED + ", _batch string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    fields = [c.split()[0] for c in CHECKED.split(", ")]
    plan = reader.parquet(checked).select(*fields).groupBy("id_unidade", "tipo").applyInPandasWithState(
        plan_unit, PLANNED, UNIT_STATE, "append", GroupStateTimeout.NoTimeout)
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, epoch: int) -> None:
        storage.replace_partitions(batch.withColumn("_batch", F.lit(f"{source}-{epoch:09d}")), planned, ["_batch"])

    run_available_now(plan, handle, checkpoint)


def bronze_handler(spark: SparkSession, tipo: str, table: str, checkpoint: str,
                   order: str = "date_first", width: int = stored.WIDTH) -> Callable[[DataFrame, int], None]:
    """The handler of ``bronze_stream``: one micro-batch is typed, de-duplicated and merged into the stored table.

    The number of the last finished micro-batch is published with the data it brought (a state of the same version), so a
    micro-batch that is replayed after its version was published is skipped, and one that died before is done again.
    """
    spec, keys = stored.SPECS[tipo]
    ledger = "epoch-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, epoch: int) -> None:
        at = ranges.current(spark, table)
        if at is not None and at.state.get(ledger, -1) >= epoch:
            return
        by = B.dedup_order(order)
        typed = B.typed_projection(batch, spec(), [c for c in B.LINEAGE if c in batch.columns])
        staged = stored.stage_upsert(spark, table, typed, keys, stored.key_range(width), by, order == "date_first",
                                     stored.bronze_checks(tipo))
        ranges.publish(spark, staged, {ledger: epoch})

    return handle


def bronze_stream(spark: SparkSession, raw_path: str, raw_schema, checkpoint: str, tipo: str, table: str,
                  order: str = "date_first", width: int = stored.WIDTH, files_per_batch: int | None = None) -> None:
    """ST2: raw -> bronze; every micro-batch rewrites only the key ranges it touches."""
    reader = spark.readStream.schema(raw_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    run_available_now(reader.parquet(raw_path), bronze_handler(spark, tipo, table, checkpoint, order, width), checkpoint)

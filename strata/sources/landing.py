"""Landing files: scan (S1-S5), decode (S6), delimiter (S7), records (S8) and
structural validation (V1-V6).

Everything is set-based over a manifest DataFrame with one row per file; the
only Python on the data path is the CSV record splitter (quoted fields and
quoted newlines), run per file inside ``mapInArrow`` and streamed in chunks.
A landing batch reads its files line by line, one file from its first to its
last line in one task (``file_lines``), so no file is ever held whole.
"""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import io
from itertools import accumulate, chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.functions import columns as C
from strata.session import small_batches

# --- fixed values: accepted landing layouts ----------------------------------
# incoming/<tipo>/id_unidade=<n>/dt=<YYYY-MM-DD>/<name>.csv
INCOMING_RE = r"^incoming/(pedido|item_pedido)/id_unidade=(\d+)/dt=(\d{4}-\d{2}-\d{2})/([^/]+\.csv)$"
# raw/id_unidade=<n>/dt=<YYYY-MM-DD>/<pedido|item_pedido>.csv
README_RE = r"^raw/id_unidade=(\d+)/dt=(\d{4}-\d{2}-\d{2})/(pedido|item_pedido)\.csv$"

RECORD_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("record_no", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])


def norm_path(c: Column) -> Column:
    """``file:///x`` and ``file:/x`` -> ``/x``; other schemes unchanged."""
    return F.regexp_replace(c, r"^file:/+", "/")


def _norm_root(root: str) -> str:
    r = root.rstrip("/")
    if r.startswith("file:"):
        r = "/" + r[len("file:"):].lstrip("/")
    return r


def parse_landing_path(rel: Column) -> dict[str, Column]:
    """Type, unit and date from a path relative to the landing root.
    An impossible date (``dt=2026-02-31``) gives NULL and so an invalid name."""
    inc_ok = rel.rlike(INCOMING_RE)
    tipo = F.when(inc_ok, F.regexp_extract(rel, INCOMING_RE, 1)).otherwise(F.regexp_extract(rel, README_RE, 3))
    unit = F.when(inc_ok, F.regexp_extract(rel, INCOMING_RE, 2)).otherwise(F.regexp_extract(rel, README_RE, 1))
    day = F.when(inc_ok, F.regexp_extract(rel, INCOMING_RE, 3)).otherwise(F.regexp_extract(rel, README_RE, 2))
    return {
        "tipo": F.nullif(tipo, F.lit("")),
        "id_unidade": F.nullif(unit, F.lit("")).try_cast("bigint"),
        "data_ref": F.try_to_date(F.nullif(day, F.lit("")), "yyyy-MM-dd"),
    }


def scan_landing(spark: SparkSession, root: str, data_ref=None) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) manifests of the files under ``root``.

    ``binaryFile`` gives no row for a 0-byte file, so the file listing of the
    same read (``inputFiles``) is compared and such files get empty content.
    valid: path, rel, tipo, id_unidade, data_ref, length, content, file_hash.
    invalid: path, rel (names outside the layout, quarantined by the caller).
    """
    content = _landed_files(spark, root).select(norm_path(F.col("path")).alias("path"), "length", "content")
    # only names are joined; contents stay in the tasks that read them
    m = content.unionByName(_unlisted(content).withColumn("content", F.lit(b"").cast("binary")))
    valid, invalid = named_files(m, root)
    return _of_date(valid, data_ref), invalid


def _landed_files(spark: SparkSession, root: str) -> DataFrame:
    # only the accepted prefixes: files moved to processed/ or rejected/ are no input again
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root.rstrip("/") + "/{incoming,raw}"))


def _unlisted(files: DataFrame) -> DataFrame:
    """(path, length) of the files that are listed but gave no row."""
    listed = files.sparkSession.createDataFrame([(p,) for p in files.inputFiles()], "path string") \
        .select(norm_path(F.col("path")).alias("path"))
    return listed.join(files.select("path"), "path", "left_anti").select("path", F.lit(0).cast("bigint").alias("length"))


def _of_date(files: DataFrame, data_ref) -> DataFrame:
    if data_ref is None:
        return files
    d = dt.date.fromisoformat(data_ref) if isinstance(data_ref, str) else data_ref
    return files.filter(F.col("data_ref") == F.lit(d))


def scan_names(spark: SparkSession, root: str, data_ref=None) -> tuple[DataFrame, DataFrame]:
    """``scan_landing`` without contents and hashes; ``uri`` is the path as Spark's readers name it."""
    files = _landed_files(spark, root).select(norm_path(F.col("path")).alias("path"), "length",
                                              F.col("_metadata.file_path").alias("uri"))
    m = files.unionByName(_unlisted(files), allowMissingColumns=True)
    valid, invalid = _by_name(m, root)
    return _of_date(valid, data_ref), invalid


def named_files(m: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) of files (path, length, content) under ``root`` by their names, with content hash."""
    valid, invalid = _by_name(m, root)
    return valid.withColumn("file_hash", F.sha2(F.col("content"), 256)), invalid


def _by_name(m: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) of files (path, length) under ``root`` by their names."""
    m = m.withColumn("rel", F.regexp_replace(F.col("path"), "^" + _escape(_norm_root(root)) + "/", ""))
    # Folder placeholders: empty objects at the top of the tree.
    m = m.filter(~((F.col("length") == 0) & (F.size(F.split("rel", "/")) <= 2)))
    m = m.withColumns(parse_landing_path(F.col("rel")))
    ok = F.col("tipo").isNotNull() & F.col("id_unidade").isNotNull() & F.col("data_ref").isNotNull()
    return m.filter(ok), m.filter(~ok).select("path", "rel")


def _escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)


def decode_text(m: DataFrame, content: str = "content", out: str = "text") -> DataFrame:
    """UTF-8 when the bytes are valid UTF-8 (a leading BOM dropped), else
    Latin-1.  Native expressions, no Python."""
    b = F.col(content)
    text = F.when(F.is_valid_utf8(b), F.decode(b, "UTF-8")).otherwise(F.decode(b, "ISO-8859-1"))
    return m.withColumn(out, F.regexp_replace(text, r"^\x{FEFF}", ""))


def detect_delimiter(text: Column) -> Column:
    """S7 (deterministic, R-7): the candidate occurring most in the header
    line (first wins a tie, in the order ``, ; | tab``); none -> ``;``."""
    header = F.substring_index(text, "\n", 1)
    counts = [(d, F.size(F.split(header, _escape(d) if d != "\t" else "\t")) - 1) for d in schemas.DELIMITERS]
    best = F.greatest(*[c for _, c in counts])
    pick = None
    for d, c in counts:
        cond = (c == best) & (best > 0)
        pick = F.when(cond, F.lit(d)) if pick is None else pick.when(cond, F.lit(d))
    return pick.otherwise(F.lit(schemas.DEFAULT_DELIMITER))


READ_ERROR = -1          # record number of the one record that tells why a file could not be read
FILE = 0                 # record number of the one record of every file: type, unit, whether it is empty
CHUNK_ROWS, CHUNK_CELLS = 20_000, 400_000


def _records(path, tipo, unit, is_empty, text, delim):
    """(record number, cells) of one file."""
    yield FILE, [tipo, None if unit is None else str(unit), None if is_empty is None else str(is_empty)]
    if is_empty or is_empty is None:
        return
    yield from _numbered(io.StringIO(text or ""), delim)


def _numbered(lines, delim):
    """(record number, cells) of the records in ``lines``."""
    try:
        yield from enumerate(csv.reader(lines, delimiter=delim), 1)
    except csv.Error as ex:                          # this file only; the rest of the batch goes on
        yield READ_ERROR, [str(ex)]


def _split_batches(batches):
    """Batches of records of a bounded number of rows and cells, over as many files as they take."""
    csv.field_size_limit(2**31 - 1)                  # a long field is data, not an error
    for batch in batches:
        paths, nums, sizes, cells = [], [], [], []
        for i in range(batch.num_rows):
            file = [batch.column(c)[i].as_py() for c in range(batch.num_columns)]
            for no, row in _records(*file):
                paths.append(file[0])
                nums.append(no)
                sizes.append(len(row))
                cells += row
                if len(nums) >= CHUNK_ROWS or len(cells) >= CHUNK_CELLS:
                    yield _record_batch(paths, nums, sizes, cells)
                    paths, nums, sizes, cells = [], [], [], []
        if nums:
            yield _record_batch(paths, nums, sizes, cells)


def _record_batch(paths, nums, sizes, cells) -> pa.RecordBatch:
    ends = pa.array([0, *accumulate(sizes)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, pa.string()), pa.array(nums, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(cells, pa.string()))],
        names=RECORD_SCHEMA.names)


def split_records(m: DataFrame) -> DataFrame:
    """One row per CSV record (``record_no`` 1 = header), quoted delimiters and newlines kept inside cells, and one
    ``FILE`` record per file.  ``m`` needs path, tipo, id_unidade, is_empty, text and delimiter; each file is parsed by
    one Python task, streamed in chunks; empty files have no text to send."""
    return m.select("path", "tipo", "id_unidade", "is_empty", F.when(~F.col("is_empty"), F.col("text")).alias("text"),
                    "delimiter").mapInArrow(_split_batches, RECORD_SCHEMA)


BOM = b"\xef\xbb\xbf"
# a codec that changes nothing and can't be entered in the middle: each file is read from first to last line by one task
# (Hadoop's shaded client, which Spark ships, has renamed the second setting)
WHOLE_FILES = {"io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec"} | dict.fromkeys(
    ["io.compress.passthrough.extension", "org.apache.hadoop.shaded.io.compress.passthrough.extension"], ".csv")
MEASURED = "uri string, file_hash string, utf8 boolean, bom boolean, ended boolean, n_lines long, is_empty boolean, header string"
CHUNK_CHARS = 4 << 20


def file_lines(spark: SparkSession, root: str, uris: list[str]) -> DataFrame:
    """(uri, size, line, utf8): the bytes between the newlines of the files ``uris``, those of a file in order in one task.

    A leading BOM and the newline after the last line are not among them; ``measure_files`` tells by the size.
    """
    small_batches(spark)
    uri = F.col("_metadata.file_path")
    rows = (spark.read.format("text").options(**WHOLE_FILES).option("lineSep", "\n").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv").load(root.rstrip("/") + "/{incoming,raw}").filter(uri.isin(uris)))
    line = F.col("value").cast("binary")
    return rows.select(uri.alias("uri"), F.col("_metadata.file_size").alias("size"), line.alias("line"),
                       F.is_valid_utf8("value").alias("utf8"))


def _files_of(batches, *columns):
    """(uri, one list per batch of a file's lines: its rows of ``columns``) of each file of a task, one after the other."""
    def runs():
        for batch in batches:
            names = batch.column("uri").dictionary_encode()
            at = names.indices.to_numpy()
            ends = [*((at[1:] != at[:-1]).nonzero()[0] + 1).tolist(), len(at)] if len(at) else []
            for a, b in zip([0, *ends], ends):
                yield names.dictionary[int(at[a])].as_py(), [batch.column(c).slice(a, b - a) for c in columns]

    for uri, parts in groupby(runs(), key=lambda x: x[0]):
        yield uri, (part for _, part in parts)


def measure_files(lines: DataFrame) -> DataFrame:
    """S5 and what S6 and S7 need of each file that has a line: content hash, whether it is UTF-8, has a BOM, ends with a
    newline, is empty, and its header line."""
    return lines.mapInArrow(_measured, MEASURED)


def _measured(batches):
    for uri, parts in _files_of(batches, "size", "line", "utf8"):
        plain, marked = hashlib.sha256(), hashlib.sha256(BOM)
        n, total, size, utf8, first, blank = 0, 0, 0, True, b"", {"utf-8": True, "latin-1": True}
        for sizes, column, valid in parts:
            rows = column.to_pylist()
            size, first = sizes[0].as_py(), rows[0] if n == 0 else first
            data = (b"\n" if n else b"") + b"\n".join(rows)
            plain.update(data)
            marked.update(data)
            n, total, utf8 = n + len(rows), total + len(data), utf8 and valid.true_count == len(valid)
            for code in [c for c in blank if blank[c] and (c != "utf-8" or utf8)]:
                blank[code] = all(not r.decode(code).strip(C.WHITE_SPACE) for r in rows)
        bom, ended = size - total > 1, size - total in (1, 4)
        if size - total not in (0, 1, 3, 4):
            raise RuntimeError(f"{uri}: {size} bytes listed, {total} read; the file has changed")
        digest = marked if bom else plain
        if ended:
            digest.update(b"\n")
        code = "utf-8" if utf8 else "latin-1"
        header = (BOM if bom and not utf8 else b"") + first
        yield pa.RecordBatch.from_pydict({
            "uri": [uri], "file_hash": [digest.hexdigest()], "utf8": [utf8], "bom": [bom], "ended": [ended], "n_lines": [n],
            "is_empty": [blank[code] and not (bom and not utf8)], "header": [header.decode(code)]}, schema=_MEASURED)


_MEASURED = pa.schema([(c, {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}[t])
                       for c, t in (x.split() for x in MEASURED.split(", "))])


def split_lines(lines: DataFrame, files: dict[str, tuple]) -> DataFrame:
    """S8 over ``file_lines``: the records of ``split_records`` without its ``FILE`` ones.

    ``files``: uri -> (path, utf8, bom, ended, n_lines, delimiter).
    """
    def run(batches):
        csv.field_size_limit(2**31 - 1)              # a long field is data, not an error
        for uri, parts in _files_of(batches, "line"):
            path, utf8, bom, ended, n_lines, delimiter = files[uri]
            code, chars = "utf-8" if utf8 else "latin-1", [0]

            def texts(rows=chain.from_iterable(p[0].to_pylist() for p in parts)):
                for no, row in enumerate(rows, 1):
                    text = ((BOM if no == 1 and bom and not utf8 else b"") + row).decode(code)
                    chars[0] += len(text)
                    yield text + "\n" if no < n_lines or ended else text

            nums, sizes, cells = [], [], []
            for no, row in _numbered(texts(), delimiter):
                nums.append(no)
                sizes.append(len(row))
                cells += row
                if len(nums) >= CHUNK_ROWS or len(cells) >= CHUNK_CELLS or chars[0] >= CHUNK_CHARS:
                    yield _record_batch([path] * len(nums), nums, sizes, cells)
                    nums, sizes, cells, chars[0] = [], [], [], 0
            if nums:
                yield _record_batch([path] * len(nums), nums, sizes, cells)

    return lines.mapInArrow(run, RECORD_SCHEMA)


def _quoted_list(arr: Column) -> Column:
    """Python-style list text: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))),
                                             ", "), F.lit("]"))


def json_list(arr: Column) -> Column:
    """JSON list text with ``", "`` separators and non-ASCII kept."""
    def q(x):
        text = F.to_json(F.array(x))             # ["..."] with every control character escaped
        return F.substring(text, 2, F.length(text) - 2)
    return F.concat(F.lit("["), F.array_join(F.transform(arr, q), ", "), F.lit("]"))


def _contract_arrays() -> tuple[Column, Column]:
    """Per-file expected columns and lower-case -> canonical map, by type."""
    exp = {t: F.array(*[F.lit(c) for c in cols]) for t, cols in schemas.EXPECTED_COLUMNS.items()}
    canon = {t: F.create_map(*[x for c in cols for x in (F.lit(c.lower()), F.lit(c))])
             for t, cols in schemas.EXPECTED_COLUMNS.items()}
    expected = F.when(F.col("tipo") == "pedido", exp["pedido"]).otherwise(exp["item_pedido"])
    cmap = F.when(F.col("tipo") == "pedido", canon["pedido"]).otherwise(canon["item_pedido"])
    return expected, cmap


def validate_files(m: DataFrame, max_errors: int = schemas.MAX_ERRORS_PER_FILE,
                   materialize=None) -> tuple[DataFrame, DataFrame]:
    """V1-V6 over decoded files.

    ``m``: path, tipo, id_unidade, text.  Returns ``(file_errors, records)``:
    file_errors = path, errors (ordered messages, the first ``max_errors`` of
    them, empty when the file is valid), n_errors (of all), header (canonical
    names), read_error (why a file could not be read; such a file is ERROR and
    its batch goes on); records = data records of every file
    (path, record_no, cells) for the caller to keep for valid files only.
    ``materialize`` (DataFrame -> DataFrame) may store the split records and
    the file headers once (e.g. as tables in the shared folder) so both outputs
    reuse one parse and no later pass reads a file again.
    """
    m = m.withColumn("delimiter", detect_delimiter(F.col("text")))
    empty = F.coalesce(F.length(C.clean("text")), F.lit(0)) == 0
    recs = split_records(m.withColumn("is_empty", empty))
    if materialize is not None:
        recs = materialize(recs)

    files = recs.filter(F.col("record_no") == FILE).select(
        "path", F.col("cells")[0].alias("tipo"), F.col("cells")[1].cast("bigint").alias("id_unidade"),
        F.col("cells")[2].cast("boolean").alias("is_empty"))
    return validate_records(recs, files, max_errors, materialize)


def validate_records(recs: DataFrame, files: DataFrame, max_errors: int = schemas.MAX_ERRORS_PER_FILE,
                     materialize=None) -> tuple[DataFrame, DataFrame]:
    """V1-V6 over the records of ``files`` (path, tipo, id_unidade, is_empty); see ``validate_files``."""
    expected, cmap = _contract_arrays()
    header = (recs.filter(F.col("record_no") == 1)
                  .select("path", F.transform("cells", C.normalize_header_name).alias("raw_header")))
    hdr = files.join(header, "path", "left")
    hdr = hdr.withColumn("header", F.transform(
        "raw_header", lambda h: F.coalesce(F.try_element_at(cmap, F.lower(h)), h)))
    missing = F.array_sort(F.array_except(expected, F.col("header")))
    extra = F.array_sort(F.array_except(F.col("header"), expected))
    schema_errors = F.filter(F.array(
        F.when(F.size(missing) > 0, F.concat(F.lit("colunas ausentes: "), _quoted_list(missing))),
        F.when(F.size(extra) > 0, F.concat(F.lit("colunas inesperadas: "), _quoted_list(extra)))),
        lambda x: x.isNotNull())
    hdr = hdr.withColumn("schema_errors", F.when(F.col("is_empty"), F.array().cast("array<string>"))
                         .otherwise(schema_errors))
    if materialize is not None:
        hdr = materialize(hdr)                       # one row per file: joins of records with it know how small it is

    # V4: width errors among non-blank data records, first ``max_errors``.
    # V4/V5 only for files whose header passed V1-V3.
    width = hdr.filter(~F.col("is_empty") & (F.size("schema_errors") == 0)).select(
        "path", F.size("header").alias("n_cols"), "tipo", "id_unidade", "header")
    data = recs.filter(F.col("record_no") > 1).join(width, "path")
    blank = ~F.exists("cells", lambda c: F.length(C.clean(c)) > 0)
    data = data.withColumn("blank", blank)
    bad = data.filter(~F.col("blank") & (F.size("cells") != F.col("n_cols")))
    w = Window.partitionBy("path").orderBy("record_no")
    bad_count = bad.groupBy("path").agg(F.count(F.lit(1)).alias("n_bad"))
    first_bad = (bad.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= max_errors)
                 .select("path", "record_no", F.format_string("linha %d: %d colunas (esperado %d)", "record_no",
                                                              F.size("cells"), "n_cols").alias("msg")))
    width_errors = first_bad.groupBy("path").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("record_no", "msg"))), lambda s: s["msg"])
        .alias("width_errors"))

    # V5 (pedido only, when V4 is clean): content units vs the path's unit.
    good = data.filter(~F.col("blank") & (F.size("cells") == F.col("n_cols")) & (F.col("tipo") == "pedido"))
    pos = F.size("header") - F.array_position(F.reverse("header"), F.lit("Id_Unidade")) + 1   # last wins
    units = good.select("path", "id_unidade", C.clean(F.try_element_at("cells", pos.cast("int"))).alias("u")) \
        .distinct()
    unit_set = (units.groupBy("path", "id_unidade")
                .agg(F.array_sort(F.collect_list("u")).alias("units"),
                     F.max(F.col("u") != F.col("id_unidade").cast("string")).alias("differs")))
    unit_err = unit_set.filter(F.col("differs")).select(
        "path", F.format_string("Id_Unidade do conteúdo %s diverge do caminho (%d)",
                                _quoted_list(F.col("units")), F.col("id_unidade")).alias("unit_error"))

    failed = recs.filter(F.col("record_no") == READ_ERROR).select("path", F.col("cells")[0].alias("read_error"))
    out = (hdr.join(width_errors, "path", "left").join(bad_count, "path", "left").join(unit_err, "path", "left")
           .join(failed, "path", "left"))
    we = F.coalesce(F.col("width_errors"), F.array().cast("array<string>"))
    errors = (F.when(F.col("read_error").isNotNull(), F.array("read_error"))
               .when(F.col("is_empty"), F.array(F.lit(schemas.MSG_EMPTY)))
               .when(F.size("schema_errors") > 0, F.col("schema_errors"))
               .when(F.size(we) > 0, we)
               .when(F.col("unit_error").isNotNull(), F.array(F.col("unit_error")))
               .otherwise(F.array().cast("array<string>")))
    shown = F.size(errors)
    file_errors = out.select("path", errors.alias("errors"), "header", "read_error",
                             F.when((shown > 0) & (errors == we), F.col("n_bad")).otherwise(shown.cast("long"))
                             .alias("n_errors"))
    records = data.filter(~F.col("blank") & (F.size("cells") == F.col("n_cols"))).select(
        "path", "record_no", "cells", "header")
    return file_errors, records


def contract_rows(records: DataFrame, tipo: str) -> DataFrame:
    """Records of valid files of one type as contract columns (header order
    free; a repeated header name takes its last column, R-12)."""
    cols = []
    for c in schemas.EXPECTED_COLUMNS[tipo]:
        pos = F.size("header") - F.array_position(F.reverse("header"), F.lit(c)) + 1
        cols.append(F.try_element_at("cells", pos.cast("int")).alias(c))
    return records.select("path", "record_no", *cols)

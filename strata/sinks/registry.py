"""Declared tables, created when missing, read by their types, widened or refused when files drift.

Rules: a declared column that a file lacks is NULL if it may be NULL, else the drift is refused; a column nobody declared is
added as nullable if ``extra="add"``, dropped if ``"drop"``, refused if ``"refuse"``; a type may grow (integers, decimals,
float to double) in either direction between file and declaration, anything else is refused; columns match without case.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas

VERSIONS = "name string, n long, schema string"
INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


class SchemaDrift(ValueError):
    """A change of schema that the rules do not allow."""


DECLARED: dict[str, T.StructType] = {
    **{f"raw_{name}": schema for name, schema in schemas.RAW_CSV_SCHEMAS.items()},
    **{f"raw_{name}": schema for name, schema in schemas.RAW_DIMENSION_SCHEMAS.items()},
    "ingestion_log": schemas.INGESTION_LOG_SCHEMA,
    "quarantine": schemas.QUARANTINE_SCHEMA,
    "unidades_esperadas": schemas.EXPECTED_UNITS_SCHEMA,
}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both without loss, None if there is none."""
    if a == b:
        return a
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.index)
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def evolve(declared: T.StructType, incoming: T.StructType, extra: str = "add") -> T.StructType:
    """The schema that takes rows of both; raises ``SchemaDrift`` where the rules don't allow it."""
    by_name = {f.name.lower(): f for f in incoming}
    out = []
    for f in declared:
        got = by_name.pop(f.name.lower(), None)
        if got is None:
            if not f.nullable:
                raise SchemaDrift(f"{f.name}: missing and not nullable")
            out.append(f)
            continue
        kind = wider(f.dataType, got.dataType)
        if kind is None:
            raise SchemaDrift(f"{f.name}: {got.dataType.simpleString()} does not fit {f.dataType.simpleString()}")
        out.append(T.StructField(f.name, kind, f.nullable))
    if by_name and extra == "refuse":
        raise SchemaDrift("not declared: " + ", ".join(sorted(by_name)))
    if extra == "add":
        out += [T.StructField(f.name, f.dataType, True) for f in by_name.values()]
    return T.StructType(out)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``; columns it lacks are NULL, others are dropped."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema])


def _versions(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(VERSIONS).parquet(f"{base}/_schemas")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current(spark: SparkSession, base: str) -> dict[str, tuple[int, T.StructType]]:
    """The newest schema of every table of ``base`` (one row per table): name -> (version, schema)."""
    found = _versions(spark, base)
    if found is None:
        return {}
    last = found.groupBy("name").agg(F.max(F.struct("n", "schema")).alias("v")).collect()
    return {r["name"]: (r["v"]["n"], T.StructType.fromJson(json.loads(r["v"]["schema"]))) for r in last}


def _declare(spark: SparkSession, base: str, rows: list[tuple[str, int, T.StructType]]) -> None:
    spark.createDataFrame([(name, n, schema.json()) for name, n, schema in rows], VERSIONS).coalesce(1) \
        .write.mode("append").parquet(f"{base}/_schemas")


def create(spark: SparkSession, base: str, tables: Mapping[str, T.StructType] = DECLARED) -> list[str]:
    """Create the declared tables that do not exist yet; returns their names."""
    have = current(spark, base)
    new = [(name, 1, schema) for name, schema in tables.items() if name not in have]
    for name, _, schema in new:
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{base}/{name}")
    if new:
        _declare(spark, base, new)
    return [name for name, *_ in new]


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table by its newest schema; files written before a column was added or widened are read in its terms."""
    have = current(spark, base)
    if name not in have:
        return spark.createDataFrame([], DECLARED[name])
    return spark.read.schema(have[name][1]).parquet(f"{base}/{name}")


def append(df: DataFrame, base: str, name: str, extra: str = "refuse") -> T.StructType:
    """Append rows to a created table by the rules; a schema that had to grow becomes the table's next version first.

    NULL in a column that must not be NULL fails the write.
    """
    n, schema = current(df.sparkSession, base)[name]
    grown = evolve(schema, df.schema, extra)
    if grown != schema:
        _declare(df.sparkSession, base, [(name, n + 1, grown)])
    rows = conform(df, grown)
    for f in grown:
        if not f.nullable:
            rows = rows.withColumn(f.name, F.coalesce(F.col(f.name), F.raise_error(F.lit(f"{name}.{f.name}: NULL")).cast(f.dataType)))
    rows.write.mode("append").parquet(f"{base}/{name}")
    return grown

"""Delivered CSV files as typed rows.

Cells are read as text, checked and converted by expressions, because the casts of a
typed CSV read are looser than the file format (they take +5 or 1d) and know one null
token only. Everything is one scan without a shuffle.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimbrook.functions.naming import DEFAULT_POLICY, CodePolicy, schema_for
from claimbrook.functions.text_types import (
    NullTokens,
    convert,
    first_type,
    fitting_types,
    invalid,
)
from claimbrook.sources.inventory import sample_of

CORRUPT = "_corrupt"
ORIGIN = "_origin"
BAD_COLUMNS = "_bad_columns"
RAW = "_raw"

# Reads both "" and \" inside quotes; no line breaks in values, so files split.
DIALECT = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "charToEscapeQuoteEscaping": "\\",
    "multiLine": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # Short rows are noticed only when all columns are parsed.
    "columnPruning": "false",
}


class HeaderError(ValueError):
    """Headers of one dataset that do not agree, or repeat a name."""


def read_header(spark: SparkSession, location: str) -> list[str]:
    """Column names of a delivery: its first filled line. Empty for an empty file."""
    first = spark.read.text(location).where(F.col("value").rlike(r"\S")).first()
    if first is None:
        return []
    return split_header(first["value"])


def split_header(line: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([line]), [])]


def read_headers(
    spark: SparkSession, locations: Sequence[str], threads: int = 8
) -> dict[str, list[str]]:
    """Headers of the deliveries of one dataset, each a one-line read."""
    with ThreadPoolExecutor(threads) as pool:
        return dict(zip(locations, pool.map(lambda x: read_header(spark, x), locations)))


def header_drift(spark: SparkSession, headers: dict[str, list[str]]) -> DataFrame:
    """Deliveries whose header differs from the first one, and how."""
    locations = list(headers)
    first = headers[locations[0]] if locations else []
    rows = []
    for location in locations:
        problem = header_problem(headers[location], first)
        if problem:
            rows.append((location, problem))
    return spark.createDataFrame(rows, "location string, problem string")


def header_problem(header: list[str], first: list[str]) -> str | None:
    if not header:
        return "empty file"
    if len(set(header)) < len(header):
        return "repeated column name"
    if header == first:
        return None
    missing = [c for c in first if c not in header]
    extra = [c for c in header if c not in first]
    if missing:
        return "missing columns: " + ", ".join(missing)
    if extra:
        return "extra columns: " + ", ".join(extra)
    return "columns in another order"


def require_one_header(headers: dict[str, list[str]]) -> list[str]:
    """The header all deliveries share; an explicit schema would bind by position."""
    locations = list(headers)
    first = headers[locations[0]]
    for location in locations:
        problem = header_problem(headers[location], first)
        if problem:
            raise HeaderError(f"{location}: {problem}")
    return first


def text_schema(header: Sequence[str]) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in header]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def raw_csv(spark: SparkSession, locations: Sequence[str], header: Sequence[str]) -> DataFrame:
    """All cells as text, with the malformed line if there is one, and the file."""
    rows = (
        spark.read.schema(text_schema(header))
        .options(**DIALECT)
        .option("header", True)
        # Part files of a folder delivery are checked as they are opened.
        .option("enforceSchema", False)
        .csv(list(locations))
    )
    # Taken from the task, not from the scan: a metadata column copies every wide row.
    return rows.withColumn(ORIGIN, F.input_file_name())


def raw_lines(lines: DataFrame, header: Sequence[str]) -> DataFrame:
    """The same for lines that came out of archives (columns origin and line)."""
    schema = text_schema(header)
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = F.from_csv("line", ddl, DIALECT)
    return lines.select(parsed.alias("cells"), F.col("origin").alias(ORIGIN)).select(
        "cells.*", ORIGIN
    )


def infer_types(
    raw: DataFrame,
    header: Sequence[str],
    policy: CodePolicy = DEFAULT_POLICY,
    nulls: NullTokens = NullTokens(),
) -> dict[str, str]:
    """Type name per column, from one aggregate over all rows.

    Columns that are codes by name need no look at their cells.
    """
    open_columns = [c for c in header if not policy.is_code(c)]
    if not open_columns:
        return {}
    # Cells become rows, so one small piece of generated code serves any number of
    # columns; the aggregate combines map-side down to a row per column.
    cells = raw.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in open_columns])))
    kept = cells.select("pos", nulls.apply(F.col("col")).alias("cell"))
    fitting = kept.select("pos", fitting_types(F.col("cell")).alias("bits"))
    # At most one row per column.
    found = fitting.groupBy("pos").agg(F.bit_and("bits").alias("bits")).collect()
    bits = {row["pos"]: row["bits"] for row in found}
    return {c: first_type(bits.get(i)) for i, c in enumerate(open_columns)}


def infer_schema(
    raw: DataFrame,
    header: Sequence[str],
    policy: CodePolicy = DEFAULT_POLICY,
    nulls: NullTokens = NullTokens(),
) -> T.StructType:
    return schema_for(list(header), infer_types(raw, header, policy, nulls), policy)


def _cells(raw: DataFrame, columns: Sequence[str], nulls: NullTokens) -> DataFrame:
    """Cells with null tokens taken out, in a projection of its own: the checks look at a
    cell several times."""
    kept = [nulls.apply(F.col(f"`{c}`")).alias(c) for c in columns]
    return raw.select(*kept, CORRUPT, ORIGIN)


def _sample() -> Column:
    return sample_of(F.col(ORIGIN)).alias("sample")


def typed_rows(
    raw: DataFrame, schema: T.StructType, nulls: NullTokens = NullTokens()
) -> DataFrame:
    """Strict rows plus sample: a malformed line or an invalid cell stops the job."""
    malformed = F.concat(
        F.lit("malformed row in "), F.col(ORIGIN), F.lit(": "), F.col(CORRUPT)
    )
    whole = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(malformed)).otherwise(F.lit(True))
    out = []
    for f in schema.fields:
        cell, type_name = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if type_name == "string":
            value = nulls.apply(cell)
        else:
            filled = cell.isNotNull()
            if nulls.never_values():
                filled = filled & ~cell.isin(list(nulls.tokens))
            else:
                cell = nulls.apply(cell)
                filled = cell.isNotNull()
            message = F.concat(
                F.lit(f"{f.name}: not a {type_name} in "), F.col(ORIGIN), F.lit(": "), cell
            )
            stop = F.when(filled, F.raise_error(message).cast(f.dataType))
            value = F.coalesce(convert(cell, type_name), stop)
        out.append(value.alias(f.name, metadata=f.metadata))
    return raw.where(whole).select(*out, _sample())


def checked_rows(
    raw: DataFrame, schema: T.StructType, nulls: NullTokens = NullTokens()
) -> DataFrame:
    """Rows with invalid cells nulled and named in an array; malformed lines kept aside."""
    bad, out = [F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT))], []
    for f in schema.fields:
        cell, type_name = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if type_name != "string":
            bad.append(F.when(invalid(cell, type_name), F.lit(f.name)))
        out.append(convert(cell, type_name).alias(f.name, metadata=f.metadata))
    as_delivered = F.to_json(F.struct(*[F.col(f"`{c}`") for c in schema.fieldNames()]))
    return _cells(raw, schema.fieldNames(), nulls).select(
        *out,
        _sample(),
        F.array_compact(F.array(*bad)).alias(BAD_COLUMNS),
        ORIGIN,
        F.coalesce(F.col(CORRUPT), as_delivered).alias(RAW),
    )


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(BAD_COLUMNS) == 0).drop(BAD_COLUMNS, ORIGIN, RAW)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """Rows set aside: where from, what is wrong, and the cells as delivered."""
    return checked.where(F.size(BAD_COLUMNS) > 0).select(
        F.col(ORIGIN).alias("origin"),
        "sample",
        F.col(BAD_COLUMNS).alias("bad_columns"),
        F.col(RAW).alias("raw"),
    )


def malformed_counts(raw: DataFrame, key: str) -> DataFrame:
    """Per file: rows, rows with a filled key, rows with too few or too many fields."""
    return raw.groupBy(F.col(ORIGIN).alias("origin")).agg(
        F.count("*").alias("rows"),
        F.count(F.col(f"`{key}`")).alias("keyed"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"),
    )


def filled_counts(raw: DataFrame, header: Sequence[str], nulls: NullTokens = NullTokens()) -> DataFrame:
    """Filled cells per column: one aggregate, then one row per column."""
    counts = [F.count(nulls.apply(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(header)]
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("filled"))
        for i, c in enumerate(header)
    ]
    return raw.agg(*counts).select(F.inline(F.array(*pairs)))

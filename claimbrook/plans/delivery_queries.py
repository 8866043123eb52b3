"""Queries that deliver the sample tables as files, take them into a lake and read it.

Every query writes whole tables in parallel (a delivery is a folder of part files), runs
the ingest on them, and returns rows of the lake or of a report. Folders are made under
the shared scratch folder; the deliveries are removed once they are in the lake.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimbrook.functions import dates
from claimbrook.functions.amounts import cents
from claimbrook.functions.naming import schema_for
from claimbrook.functions.text_types import FALSE_TOKENS, NULL_TOKENS, TRUE_TOKENS
from claimbrook.operators import lines, quality
from claimbrook.plans import convert
from claimbrook.plans.registry import query, table
from claimbrook.session import scratch
from claimbrook.sources import archives as zips
from claimbrook.sources import csv_scan, inventory, lake, manifest, storage
from claimbrook.sources.kinds import (
    KIND_BY_NAME,
    KINDS,
    SAMPLES,
    Kind,
    family_schema,
    fields_of,
    release_schemas,
)
from claimbrook.streaming import ingest

BENE = KIND_BY_NAME["beneficiary_2008"]
CARRIER = KIND_BY_NAME["carrier_claims"]


def deliver(
    rows: DataFrame, landing: str, kind: Kind, sample: Column, half: Column | None = None
) -> None:
    """Write rows as CSV deliveries of a dataset, each a folder of parts. No shuffle."""
    name = F.concat(
        F.lit(f"{kind.stem}_Sample_"),
        sample.cast("string"),
        F.lit("") if half is None else half,
        F.lit(".csv"),
    )
    (
        rows.withColumn("delivery", name)
        .write.mode("append")
        .partitionBy("delivery")
        .option("header", True)
        .option("escape", '"')
        .csv(landing)
    )


def deliver_lines(
    rows: DataFrame, header: str, line: Column, landing: str, kind: Kind, sample: Column
) -> None:
    """The same for lines that are already text, whatever number of fields they have."""
    name = F.concat(F.lit(f"{kind.stem}_Sample_"), sample.cast("string"), F.lit(".csv"))
    (
        rows.select(line.alias(header), name.alias("delivery"))
        .write.mode("append")
        .partitionBy("delivery")
        .option("header", True)
        .option("sep", "\u0001")
        .option("quoteAll", False)
        .csv(landing)
    )


def _key_sample(key: str) -> Column:
    return F.col(key) % len(SAMPLES) + 1


def _members(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("cust_id"),
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )


def _member_sample() -> Column:
    return F.col("cust_id").cast("bigint") % len(SAMPLES) + 1


def _convert(
    spark: SparkSession, landing: str, options: convert.Options | None = None
) -> tuple[str, DataFrame]:
    target = scratch(spark, "lake")
    results = convert.convert_deliveries(spark, landing, target, options)
    storage.delete_folder(spark, landing)
    return target, results


def _written(results: DataFrame) -> None:
    """Stop with the detail when a dataset did not convert."""
    failed = results.where("status = 'failed'").first()
    if failed:
        raise RuntimeError(f"{failed['kind']}: {failed['detail']}")


def _members_lake(spark: SparkSession, folder: str) -> str:
    landing = scratch(spark, "landing")
    deliver(_members(spark, folder), landing, BENE, _member_sample())
    target, results = _convert(spark, landing)
    _written(results)
    return f"{target}/{BENE.output_name}"


_PER_SAMPLE_SQL = (
    "SELECT CAST(c_custkey%20+1 AS INT) AS sample, COUNT(*) AS n FROM customer GROUP BY 1"
)


@query("q_rows_per_sample", _PER_SAMPLE_SQL)
def rows_per_sample(spark: SparkSession, folder: str) -> DataFrame:
    return lake.rows_per_sample(lake.read_dataset(spark, _members_lake(spark, folder)))


@query(
    "q_ingest_roundtrip",
    """
    SELECT LPAD(CAST(c_custkey AS VARCHAR(20)),9,'0') AS cust_id, c_name,
      CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
      CAST(c_custkey%20+1 AS INT) AS sample FROM customer
    """,
)
def ingest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return lake.read_dataset(spark, _members_lake(spark, folder))


@query(
    "q_read_samples",
    """
    SELECT LPAD(CAST(c_custkey AS VARCHAR(20)),9,'0') AS cust_id,
      CAST(c_custkey%20+1 AS INT) AS sample FROM customer WHERE c_custkey%20+1 IN (2, 3, 5)
    """,
)
def read_samples(spark: SparkSession, folder: str) -> DataFrame:
    rows = lake.read_dataset(spark, _members_lake(spark, folder), [2, 3, 5])
    return rows.select("cust_id", "sample")


@query(
    "q_inspect",
    """
    SELECT COUNT(*) AS row_count, CAST(5 AS INT) AS column_count, 'sample' AS partition_columns,
      COUNT(DISTINCT c_custkey%20) AS partition_count, TRUE AS has_files FROM customer
    """,
)
def inspect(spark: SparkSession, folder: str) -> DataFrame:
    found = lake.inspect_dataset(spark, _members_lake(spark, folder))
    has_files = (F.col("parquet_files") >= F.col("partition_count")) & (F.col("size_bytes") > 0)
    return found.select(
        "row_count",
        "column_count",
        "partition_columns",
        "partition_count",
        has_files.alias("has_files"),
    )


@query(
    "q_carrier_union",
    """
    SELECT CAST(l_orderkey%20+1 AS INT) AS sample, COUNT(*) AS n,
      CAST(SUM(CAST(ROUND(l_extendedprice*100) AS BIGINT)) AS BIGINT) AS cents
    FROM lineitem GROUP BY 1
    """,
)
def carrier_union(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("clm_id"), "l_linenumber", "l_extendedprice", "l_returnflag"
    )
    half = F.when(F.col("clm_id") % 2 == 0, "A").otherwise("B")
    # Halves go to samples by the order's other digits, so that each sample has both.
    sample = F.pmod(F.xxhash64("clm_id"), F.lit(len(SAMPLES))) + 1
    deliver(items, landing, CARRIER, sample, half)
    target, results = _convert(spark, landing)
    _written(results)
    rows = lake.read_dataset(spark, f"{target}/{CARRIER.output_name}")
    by_order = (F.col("clm_id").cast("bigint") % 20 + 1).cast("int").alias("sample")
    return rows.groupBy(by_order).agg(
        F.count("*").alias("n"), F.sum(cents(F.col("l_extendedprice"))).alias("cents")
    )


@query(
    "q_carrier_rows",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS clm_id, CAST(l_linenumber AS BIGINT) AS line,
      l_extendedprice AS amt, CAST((l_orderkey+l_linenumber)%20+1 AS INT) AS sample FROM lineitem
    """,
)
def carrier_rows(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("clm_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("amt"),
    )
    half = F.when(F.col("line") <= 3, "A").otherwise("B")
    deliver(items, landing, CARRIER, (F.col("clm_id") + F.col("line")) % 20 + 1, half)
    target, results = _convert(spark, landing, convert.Options(infer="all"))
    _written(results)
    return lake.read_dataset(spark, f"{target}/{CARRIER.output_name}")


@query(
    "q_carrier_lines",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS clm_id, CAST(l_linenumber AS INT) AS line_num,
      LPAD(CAST(MIN(l_partkey) AS VARCHAR), 5, '0') AS hcpcs_cd, MAX(l_extendedprice) AS nch_pmt_amt,
      CAST(l_orderkey%20+1 AS INT) AS sample
    FROM lineitem GROUP BY l_orderkey, l_linenumber
    """,
)
def carrier_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Carrier files of all 142 columns, taken in with the documented schema, by line."""
    line = F.col("l_linenumber")
    cells = {}
    for f in family_schema("carrier"):
        cells[f.name] = F.lit(None).cast("string")
    for i in range(1, 8):
        code = F.min(F.when(line == i, F.col("l_partkey")))
        amount = F.max(F.when(line == i, F.col("l_extendedprice")))
        cells[f"HCPCS_CD_{i}"] = F.lpad(code.cast("string"), 5, "0")
        cells[f"LINE_NCH_PMT_AMT_{i}"] = amount.cast("string")
    claims = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("key"))
        .agg(
            F.min("l_shipdate").alias("from"),
            F.max("l_shipdate").alias("thru"),
            *[c.alias(n) for n, c in cells.items() if n.startswith(("HCPCS", "LINE_NCH"))],
        )
    )
    cells["CLM_ID"] = F.col("key").cast("string")
    cells["DESYNPUF_ID"] = F.lpad(F.col("key").cast("string"), 16, "0")
    cells["CLM_FROM_DT"] = F.date_format("from", "yyyyMMdd")
    cells["CLM_THRU_DT"] = F.date_format("thru", "yyyyMMdd")
    wide = claims.select(
        *[(F.col(n) if n in claims.columns else c).alias(n) for n, c in cells.items()]
    )
    landing = scratch(spark, "landing")
    sample = F.col("CLM_ID").cast("bigint") % 20 + 1
    half = F.when(F.col("CLM_ID").endswith("7"), "B").otherwise("A")
    deliver(wide, landing, CARRIER, sample, half)
    target, results = _convert(spark, landing, convert.Options(schemas=release_schemas()))
    _written(results)
    rows = lake.read_dataset(spark, f"{target}/{CARRIER.output_name}")
    found = lines.carrier_lines(rows, ["HCPCS_CD", "LINE_NCH_PMT_AMT"])
    return found.select(
        F.col("CLM_ID").alias("clm_id"), "line_num", "hcpcs_cd", "nch_pmt_amt", "sample"
    )


@query(
    "q_null_tokens",
    "SELECT c_custkey, CASE WHEN c_custkey%7=6 THEN c_mktsegment END AS seg FROM customer",
)
def null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    turn = F.col("c_custkey") % 7
    token = F.element_at(F.array(*[F.lit(t) for t in NULL_TOKENS]), (turn + 1).cast("int"))
    cell = F.when(turn < len(NULL_TOKENS), token).otherwise(F.col("c_mktsegment"))
    people = table(spark, folder, "customer").select("c_custkey", cell.alias("seg"))
    deliver(people, landing, BENE, _key_sample("c_custkey"))
    target, results = _convert(spark, landing)
    _written(results)
    rows = lake.read_dataset(spark, f"{target}/{BENE.output_name}")
    return rows.select("c_custkey", "seg")


@query("q_bool_tokens", "SELECT c_custkey, c_custkey%14 < 7 AS flag FROM customer")
def bool_tokens(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    words = TRUE_TOKENS + FALSE_TOKENS
    turn = (F.col("c_custkey") % len(words) + 1).cast("int")
    cell = F.element_at(F.array(*[F.lit(w) for w in words]), turn)
    people = table(spark, folder, "customer").select("c_custkey", cell.alias("flag"))
    deliver(people, landing, BENE, _key_sample("c_custkey"))
    known = schema_for(["c_custkey", "flag"], {"c_custkey": "bigint", "flag": "boolean"})
    target, results = _convert(spark, landing, convert.Options(schemas={BENE.name: known}))
    _written(results)
    rows = lake.read_dataset(spark, f"{target}/{BENE.output_name}")
    return rows.select("c_custkey", "flag")


_TYPED_COLUMNS = {
    "no_value": "string",
    "whole": "bigint",
    "zero_one": "bigint",
    "truth": "boolean",
    "day": "date",
    "clock": "string",
    "moment": "timestamp_ntz",
    "amount": "double",
    "words": "string",
    "whole_or_nan": "double",
    "twenty_digits": "double",
    "padded_cd": "string",
    "day_number": "bigint",
}


def _typed_orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    cells = {
        "no_value": F.lit(None).cast("string"),
        "whole": F.col("o_custkey"),
        "zero_one": key % 2,
        "truth": F.when(key % 2 == 0, "true").otherwise("False"),
        "day": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "clock": F.date_format("o_orderdate", "HH:mm:ss"),
        "moment": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "amount": F.col("o_totalprice"),
        "words": F.col("o_orderpriority"),
        "whole_or_nan": F.when(key % 5 == 0, "NaN").otherwise(key.cast("string")),
        "twenty_digits": F.concat(F.lit("1"), F.lpad(key.cast("string"), 19, "0")),
        "padded_cd": F.lpad(key.cast("string"), 8, "0"),
        "day_number": F.date_format("o_orderdate", "yyyyMMdd"),
    }
    return table(spark, folder, "orders").select(*[c.alias(n) for n, c in cells.items()])


def _typed_delivery(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    landing = scratch(spark, "landing")
    deliver(_typed_orders(spark, folder), landing, KIND_BY_NAME["inpatient_claims"], F.lit(1))
    location = inventory.artifacts(inventory.file_inventory(spark, landing)).first()["location"]
    header = csv_scan.read_header(spark, location)
    return csv_scan.raw_csv(spark, [location], header), header


_FILLED_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS column_name, '{kind}' AS stored_type, "
    f"{'COUNT(NULL)' if name == 'no_value' else 'COUNT(*)'} AS filled FROM orders"
    for name, kind in _TYPED_COLUMNS.items()
)


@query("q_type_inference", _FILLED_SQL)
def type_inference(spark: SparkSession, folder: str) -> DataFrame:
    raw, header = _typed_delivery(spark, folder)
    schema = csv_scan.infer_schema(raw, header)
    stored = spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in schema], "column string, stored_type string"
    )
    filled = csv_scan.filled_counts(raw, header)
    return filled.join(stored, "column").select(
        F.col("column").alias("column_name"), "stored_type", "filled"
    )


_SEMANTICS = {
    "bigint": "integer",
    "double": "float",
    "boolean": "boolean",
    "date": "date",
    "timestamp_ntz": "timestamp",
    "string": "text",
}


@query(
    "q_field_catalog",
    "\nUNION ALL\n".join(
        f"SELECT 'inpatient' AS family, '{name}' AS column_name, CAST({i} AS INT) AS position, "
        f"'{'string_code' if name.endswith('_cd') else _SEMANTICS[kind]}' AS semantic, "
        f"'{kind}' AS stored_type"
        for i, (name, kind) in enumerate(_TYPED_COLUMNS.items(), 1)
    ),
)
def field_catalog(spark: SparkSession, folder: str) -> DataFrame:
    raw, header = _typed_delivery(spark, folder)
    fields = fields_of(spark, csv_scan.infer_schema(raw, header), "inpatient")
    return fields.select(
        "family",
        F.col("column").alias("column_name"),
        "position",
        "semantic",
        F.col("type").alias("stored_type"),
    )


def _part_names(spark: SparkSession, folder: str) -> DataFrame:
    """File names out of part keys: all datasets, some out of range, misspelt or halfless."""
    key = F.col("p_partkey")
    number = (key % 23).cast("string")
    turn = key % 10
    half = F.when(key % 3 == 0, "A").otherwise("B")
    before = [f"{k.stem}_Sample_" for k in KINDS]
    before += [f"{CARRIER.stem}_Sample_", BENE.stem.lower() + "_sample_", "ignored_"]
    stem = F.element_at(F.array(*[F.lit(x) for x in before]), (turn + 1).cast("int"))
    halves = [i for i, k in enumerate(KINDS) if k.halves]
    name = F.concat(stem, number, F.when(turn.isin(halves), half).otherwise(""), F.lit(".csv"))
    return table(spark, folder, "part").select("p_partkey", name.alias("file_name"))


def _part_names_sql() -> str:
    branches = []
    for i, k in enumerate(KINDS):
        half = "CASE WHEN p_partkey%3=0 THEN 'A' ELSE 'B' END" if k.halves else "''"
        branches.append(
            f"WHEN p_partkey%10={i} THEN '{k.stem}_Sample_' || p_partkey%23 || {half} || '.csv'"
        )
    branches.append(f"WHEN p_partkey%10=7 THEN '{CARRIER.stem}_Sample_' || p_partkey%23 || '.csv'")
    branches.append(
        f"WHEN p_partkey%10=8 THEN '{BENE.stem.lower()}_sample_' || p_partkey%23 || '.csv'"
    )
    kinds = " ".join(
        rf"WHEN regexp_matches(file_name, '^{k.stem}_Sample_[0-9]+{'[AB]' if k.halves else ''}\.csv$') THEN '{k.name}'"
        for k in KINDS
    )
    return f"""
    names AS (
      SELECT p_partkey, CASE {" ".join(branches)}
        ELSE 'ignored_' || p_partkey%23 || '.csv' END AS file_name FROM part),
    kinds AS (SELECT *, CASE {kinds} END AS kind FROM names),
    parsed AS (
      SELECT p_partkey, file_name, kind,
        CASE WHEN kind IS NOT NULL THEN
          CAST(regexp_extract(file_name, '_Sample_([0-9]+)', 1) AS INT) END AS sample,
        CASE WHEN kind='carrier_claims' THEN
          regexp_extract(file_name, '([AB])\\.csv$', 1) END AS part FROM kinds),
    judged AS (
      SELECT *, CASE WHEN kind IS NULL THEN 'unrecognised file name'
        WHEN sample NOT BETWEEN 1 AND 20 THEN 'sample out of range' END AS reject_reason FROM parsed)
    """


@query("q_filename_parse", f"WITH {_part_names_sql()} SELECT * FROM judged")
def filename_parse(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.parse_names(_part_names(spark, folder))


@query(
    "q_file_groups",
    f"""
    WITH {_part_names_sql()},
    ranked AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY kind
        ORDER BY sample, COALESCE(part,''), file_name) AS rn
      FROM judged WHERE reject_reason IS NULL),
    k AS (SELECT * FROM (VALUES
      {", ".join(f"({i}, '{k.name}', '{k.output_name}')" for i, k in enumerate(KINDS, 1))})
      AS t(rank, kind, output_name))
    SELECT CAST(k.rank AS INT) AS rank, r.kind, k.output_name, COUNT(*) AS files,
      COUNT(DISTINCT sample) AS samples, MAX(CASE WHEN rn=1 THEN file_name END) AS first_file
    FROM ranked r JOIN k ON k.kind=r.kind GROUP BY 1,2,3
    """,
)
def file_groups(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.group_by_kind(inventory.parse_names(_part_names(spark, folder)))


def _event_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archive names out of events: the type names the dataset, the user the sample."""
    sample = (F.col("user_id") % 23).cast("string")
    name = F.when(
        F.col("event_type") == "view",
        F.concat(F.lit("de1_0_2008_beneficiary_summary_file_sample_"), sample, F.lit(".zip")),
    )
    name = name.when(
        F.col("event_type") == "click",
        F.concat(F.lit("DE1_0_2008_to_2010_Carrier_Claims_Sample_"), sample, F.lit("A.zip")),
    ).otherwise(
        F.concat(F.lit("DE1_0_2008_to_2010_Inpatient_Claims_Sample_"), sample, F.lit(".zip"))
    )
    broken = F.when(F.col("value") < 1, "extract_failed").otherwise("extracted")
    return table(spark, folder, "events").select(name.alias("filename"), broken.alias("status"))


_EVENT_ARCHIVES_SQL = """
    found AS (
      SELECT CASE event_type
        WHEN 'view' THEN 'de1_0_2008_beneficiary_summary_file_sample_' || user_id%23 || '.zip'
        WHEN 'click' THEN 'DE1_0_2008_to_2010_Carrier_Claims_Sample_' || user_id%23 || 'A.zip'
        ELSE 'DE1_0_2008_to_2010_Inpatient_Claims_Sample_' || user_id%23 || '.zip' END AS filename,
        CASE WHEN value < 1 THEN 'extract_failed' ELSE 'extracted' END AS status FROM events)
"""


def _manifest_sql() -> str:
    specs = ", ".join(
        f"({i}, '{kind}', {f"'{half}'" if half else 'NULL'}, '{name}', '{address}')"
        for i, (kind, half, name, address) in enumerate(manifest.ARCHIVES)
    )
    return f"""
    specs AS (SELECT * FROM (VALUES {specs}) AS t(no, kind, part, name, address)),
    listed AS (
      SELECT CAST((sample-1)*8 + no AS INT) AS position, CAST(sample AS INT) AS sample, kind, part,
        CASE WHEN sample=1 AND kind='beneficiary_2010' THEN 'DE1_0_2010_Beneficiary_Summary_File_Sample_1.zip'
          WHEN sample=11 AND part='A' THEN 'DE1_0_2008_to_2010_Carrier_Claims_Sample_11A.csv.zip'
          ELSE REPLACE(name, '%s', CAST(sample AS VARCHAR)) END AS filename,
        CASE WHEN sample=1 AND kind='beneficiary_2010' THEN '{manifest.SITE}{manifest.UPLOAD_PATH}'
          WHEN sample=20 AND kind IN ('beneficiary_2008','inpatient_claims')
          THEN '{manifest.SITE}{manifest.LEGACY_PATH}' ELSE address END AS address
      FROM specs, (SELECT UNNEST(RANGE(1, 21)) AS sample) s),
    expected AS (
      SELECT position, sample, kind AS file_kind, kind AS dataset_kind, part, filename,
        address || filename AS url FROM listed)
    """


@query(
    "q_manifest",
    f"""
    WITH {_manifest_sql()}, {_EVENT_ARCHIVES_SQL}
    SELECT e.*, CASE WHEN f.filename IS NOT NULL THEN 'skipped' ELSE 'planned' END AS status,
      CASE WHEN f.filename IS NOT NULL THEN 'Skipped existing archive' ELSE '' END AS detail
    FROM expected e LEFT JOIN (SELECT DISTINCT filename FROM found) f ON e.filename=f.filename
    """,
)
def manifest_status(spark: SparkSession, folder: str) -> DataFrame:
    wanted = manifest.expected_manifest(spark, manifest.pick_samples(everything=True))
    return manifest.fetch_status(wanted, _event_archives(spark, folder))


@query(
    "q_fetch_plan",
    f"""
    WITH {_manifest_sql()}, {_EVENT_ARCHIVES_SQL}
    SELECT e.* FROM expected e WHERE NOT EXISTS (
      SELECT 1 FROM found f WHERE f.filename=e.filename)
    """,
)
def fetch_plan(spark: SparkSession, folder: str) -> DataFrame:
    wanted = manifest.expected_manifest(spark, manifest.pick_samples(everything=True))
    return manifest.plan_fetch(wanted, _event_archives(spark, folder))


@query(
    "q_member_status",
    f"""
    WITH {_manifest_sql()}, {_EVENT_ARCHIVES_SQL}
    SELECT e.filename, CASE WHEN f.filename IS NOT NULL THEN 'skipped' ELSE 'planned' END AS status
    FROM expected e LEFT JOIN (SELECT DISTINCT filename FROM found WHERE status='extracted') f
    ON e.filename=f.filename
    """,
)
def member_status(spark: SparkSession, folder: str) -> DataFrame:
    wanted = manifest.expected_manifest(spark, manifest.pick_samples(everything=True))
    return manifest.member_status(wanted, _event_archives(spark, folder)).select(
        "filename", "status"
    )


def _nation_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries of members by nation as the sample (up to 25, so some are out of range),
    and of one half of the carrier claims."""
    landing = scratch(spark, "landing")
    deliver(_members(spark, folder), landing, BENE, F.col("c_nationkey") + 1)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    deliver(orders, landing, CARRIER, F.col("o_custkey") % 15 + 1, F.lit("A"))
    listed = inventory.file_inventory(spark, landing)
    storage.delete_folder(spark, landing)
    return listed


@query(
    "q_missing_deliveries",
    f"""
    WITH {_manifest_sql()}
    SELECT position, dataset_kind, sample, part FROM expected e
    WHERE NOT (dataset_kind='beneficiary_2008'
        AND sample IN (SELECT c_nationkey+1 FROM customer))
      AND NOT (dataset_kind='carrier_claims' AND part='A'
        AND sample IN (SELECT o_custkey%15+1 FROM orders))
    """,
)
def missing_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    there = _nation_inventory(spark, folder)
    wanted = manifest.expected_manifest(spark, manifest.pick_samples(everything=True))
    return manifest.missing_deliveries(wanted, there)


@query(
    "q_inventory",
    f"""
    SELECT DISTINCT '{BENE.stem}_Sample_' || (c_nationkey+1) || '.csv' AS file_name,
      'beneficiary_2008' AS kind, CAST(c_nationkey+1 AS INT) AS sample, CAST(NULL AS VARCHAR) AS part,
      CASE WHEN c_nationkey+1 > 20 THEN 'sample out of range' END AS reject_reason, TRUE AS has_bytes
    FROM customer
    UNION ALL
    SELECT DISTINCT '{CARRIER.stem}_Sample_' || (o_custkey%15+1) || 'A.csv', 'carrier_claims',
      CAST(o_custkey%15+1 AS INT), 'A', CAST(NULL AS VARCHAR), TRUE FROM orders
    """,
)
def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    files = _nation_inventory(spark, folder)
    keys = ["file_name", "kind", "sample", "part", "reject_reason"]
    return files.groupBy(*keys).agg((F.sum("length") > 0).alias("has_bytes"))


@query(
    "q_missing_samples",
    """
    SELECT CAST(s AS INT) AS sample FROM (SELECT UNNEST(RANGE(1, 21)) AS s) t
    WHERE s NOT IN (SELECT c_nationkey%18+1 FROM customer)
    """,
)
def missing_samples(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    deliver(_members(spark, folder), landing, BENE, F.col("c_nationkey") % 18 + 1)
    target, results = _convert(spark, landing)
    _written(results)
    return quality.missing_samples(lake.read_dataset(spark, f"{target}/{BENE.output_name}"))


_STATUS_WORDS = {
    "view": "skipped",
    "click": "extracted",
    "signup": "extract_failed",
    "error": "download_failed",
    "purchase": "validated",
}


def _event_results(spark: SparkSession, folder: str) -> DataFrame:
    """Archive results out of events; whole dollars stand for bytes."""
    status = F.lit(None).cast("string")
    for word, name in _STATUS_WORDS.items():
        status = F.when(F.col("event_type") == word, name).otherwise(status)
    size = F.floor("value").cast("bigint")
    return table(spark, folder, "events").select("event_id", status.alias("status"), size.alias("bytes"))


@query(
    "q_status_summary",
    """
    SELECT COUNT(*) AS total_files, COUNT(CASE WHEN event_type='view' THEN 1 END) AS skipped_files,
      COUNT(CASE WHEN event_type<>'view' THEN 1 END) AS attempted_files,
      COUNT(CASE WHEN event_type IN ('click','signup') THEN 1 END) AS successful_downloads,
      COUNT(CASE WHEN event_type='error' THEN 1 END) AS failed_downloads,
      COUNT(CASE WHEN event_type='click' THEN 1 END) AS successful_extractions,
      COUNT(CASE WHEN event_type='signup' THEN 1 END) AS failed_extractions,
      COUNT(CASE WHEN event_type='purchase' THEN 1 END) AS validated_files,
      COUNT(CASE WHEN event_type='error' AND FLOOR(value)=0 THEN 1 END) AS failed_validations
    FROM events
    """,
)
def status_summary(spark: SparkSession, folder: str) -> DataFrame:
    return convert.delivery_summary(_event_results(spark, folder))


@query(
    "q_failures",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN 'download_failed' ELSE 'extract_failed' END
      AS status, CAST(FLOOR(value) AS BIGINT) AS bytes
    FROM events WHERE event_type IN ('error','signup')
    """,
)
def failures(spark: SparkSession, folder: str) -> DataFrame:
    return convert.delivery_failures(_event_results(spark, folder))


@query(
    "q_conversion_summary",
    """
    SELECT COUNT(CASE WHEN o_orderstatus='O' THEN 1 END) AS successful_datasets,
      COUNT(CASE WHEN o_orderstatus='F' THEN 1 END) AS failed_datasets,
      COUNT(CASE WHEN o_orderstatus='P' THEN 1 END) AS skipped_datasets FROM orders
    """,
)
def conversion_summary(spark: SparkSession, folder: str) -> DataFrame:
    state = F.col("o_orderstatus")
    words = F.when(state == "O", "written").when(state == "F", "failed").when(state == "P", "skipped")
    return convert.conversion_summary(table(spark, folder, "orders").select(words.alias("status")))


def _all_families(spark: SparkSession, folder: str, landing: str) -> None:
    """A whole release: every dataset out of a table, all samples, written side by side."""
    half = F.when(F.col("l_linenumber") <= 3, "A").otherwise("B")
    parts = [
        ("carrier_claims", table(spark, folder, "lineitem"), _key_sample("l_orderkey"), half),
        ("inpatient_claims", table(spark, folder, "orders"), _key_sample("o_orderkey"), None),
        ("outpatient_claims", table(spark, folder, "part"), _key_sample("p_partkey"), None),
        (
            "prescription_drug_events",
            table(spark, folder, "events").drop("props"),
            _key_sample("event_id"),
            None,
        ),
    ]
    for name in ("beneficiary_2008", "beneficiary_2009", "beneficiary_2010"):
        parts.append((name, _members(spark, folder), _member_sample(), None))
    with ThreadPoolExecutor(len(parts)) as pool:
        jobs = [
            pool.submit(deliver, rows, f"{landing}/{name}", KIND_BY_NAME[name], sample, half)
            for name, rows, sample, half in parts
        ]
        for job in jobs:
            job.result()
    # Writers side by side need folders of their own; the deliveries then move together.
    for name, *_ in parts:
        storage.move_children(spark, f"{landing}/{name}", landing)


_RELEASE_TABLES = {
    "beneficiary_2008": ("customer", 5),
    "beneficiary_2009": ("customer", 5),
    "beneficiary_2010": ("customer", 5),
    "inpatient_claims": ("orders", 6),
    "outpatient_claims": ("part", 6),
    "prescription_drug_events": ("events", 5),
    "carrier_claims": ("lineitem", 11),
}


@query(
    "q_release",
    "\nUNION ALL\n".join(
        f"SELECT '{kind}' AS kind, 'written' AS status, COUNT(*) AS row_count, "
        f"CAST({width} AS INT) AS column_count, '' AS detail FROM {name}"
        for kind, (name, width) in _RELEASE_TABLES.items()
    ),
)
def release(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    _all_families(spark, folder, landing)
    _, results = _convert(spark, landing, convert.Options(at_once=len(KINDS)))
    return results.select("kind", "status", "row_count", "column_count", "detail")


@query(
    "q_isolation",
    """
    SELECT 'beneficiary_2008' AS kind, 'written' AS status, COUNT(*) AS row_count FROM customer
    UNION ALL SELECT 'carrier_claims', 'failed', CAST(0 AS BIGINT)
    UNION ALL SELECT unnest(['beneficiary_2009','beneficiary_2010','inpatient_claims',
      'outpatient_claims','prescription_drug_events']), 'skipped', CAST(0 AS BIGINT)
    """,
)
def isolation(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    deliver(_members(spark, folder), landing, BENE, _member_sample())
    orders = table(spark, folder, "orders")
    # Sample 1 has whole amounts; later samples do not, so the claims cannot convert.
    amount = F.when(_key_sample("o_orderkey") == 1, F.lit("7")).otherwise(F.lit("7.5"))
    deliver(
        orders.select("o_orderkey", amount.alias("amount")),
        landing,
        CARRIER,
        _key_sample("o_orderkey"),
        F.lit("A"),
    )
    _, results = _convert(spark, landing)
    return results.select("kind", "status", "row_count")


@query(
    "q_drift",
    f"""
    SELECT DISTINCT '{BENE.stem}_Sample_' || (c_custkey%20+1) || '.csv' AS file_name,
      CASE WHEN c_custkey%20+1 > 15 THEN 'missing columns: c_name'
        ELSE 'columns in another order' END AS problem
    FROM customer WHERE c_custkey%20+1 > 10
    """,
)
def drift(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    people, sample = _members(spark, folder), _member_sample()
    later = people.select("c_name", "cust_id", "c_nationkey", "c_acctbal", "c_mktsegment")
    deliver(people.where(sample <= 10), landing, BENE, sample)
    deliver(later.where((sample > 10) & (sample <= 15)), landing, BENE, sample)
    deliver(people.drop("c_name").where(sample > 15), landing, BENE, sample)
    found = inventory.artifacts(inventory.file_inventory(spark, landing)).collect()
    headers = csv_scan.read_headers(spark, [row["location"] for row in found])
    storage.delete_folder(spark, landing)
    return csv_scan.header_drift(spark, headers).select(
        inventory.delivery_name(F.col("location")).alias("file_name"), "problem"
    )


def _uneven_lines(spark: SparkSession, folder: str, landing: str) -> None:
    """Three fields a line, but every tenth order has two and every thirteenth four."""
    key = F.col("o_orderkey").cast("string")
    full = F.concat_ws(",", key, F.col("o_custkey").cast("string"), F.col("o_orderstatus"))
    short = F.concat_ws(",", key, F.col("o_custkey").cast("string"))
    line = (
        F.when(F.col("o_orderkey") % 10 == 0, short)
        .when(F.col("o_orderkey") % 13 == 0, F.concat(full, F.lit(",more")))
        .otherwise(full)
    )
    deliver_lines(
        table(spark, folder, "orders"),
        "o_orderkey,o_custkey,o_orderstatus",
        line,
        landing,
        KIND_BY_NAME["inpatient_claims"],
        _key_sample("o_custkey"),
    )


@query(
    "q_malformed",
    """
    SELECT CAST(o_custkey%20+1 AS INT) AS sample, COUNT(*) AS n, COUNT(o_orderkey) AS keyed,
      COUNT(CASE WHEN o_orderkey%10=0 OR o_orderkey%13=0 THEN 1 END) AS malformed
    FROM orders GROUP BY 1
    """,
)
def malformed(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch(spark, "landing")
    _uneven_lines(spark, folder, landing)
    found = inventory.artifacts(inventory.file_inventory(spark, landing)).collect()
    locations = [row["location"] for row in found]
    header = csv_scan.require_one_header(csv_scan.read_headers(spark, locations))
    per_file = csv_scan.malformed_counts(csv_scan.raw_csv(spark, locations, header), header[0])
    return per_file.groupBy(inventory.sample_of(F.col("origin")).alias("sample")).agg(
        F.sum("rows").alias("n"),
        F.sum("keyed").alias("keyed"),
        F.sum("malformed").alias("malformed"),
    )


@query(
    "q_quarantine",
    """
    SELECT CAST(o_custkey%20+1 AS INT) AS sample,
      CASE WHEN o_orderkey%10=0 OR o_orderkey%13=0 THEN '_corrupt'
        WHEN o_orderkey%7=0 THEN 'amount' WHEN o_orderkey%11=0 THEN 'days,amount'
        ELSE '' END AS problem, COUNT(*) AS n
    FROM orders GROUP BY 1,2
    """,
)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    landing, aside = scratch(spark, "landing"), scratch(spark, "aside")
    key = F.col("o_orderkey")
    days = F.when(key % 11 == 0, "+5").otherwise("5")
    amount = F.when(key % 7 == 0, "1d").when(key % 11 == 0, "2f").otherwise("2.5")
    days = F.when(key % 7 == 0, "5").otherwise(days)
    whole = F.concat_ws(",", key.cast("string"), days, amount)
    line = (
        F.when(key % 10 == 0, key.cast("string"))
        .when(key % 13 == 0, F.concat(whole, F.lit(",more")))
        .otherwise(whole)
    )
    kind = KIND_BY_NAME["outpatient_claims"]
    deliver_lines(
        table(spark, folder, "orders"),
        "o_orderkey,days,amount",
        line,
        landing,
        kind,
        _key_sample("o_custkey"),
    )
    known = schema_for(
        ["o_orderkey", "days", "amount"],
        {"o_orderkey": "bigint", "days": "bigint", "amount": "double"},
    )
    options = convert.Options(schemas={kind.name: known}, quarantine=aside)
    target, results = _convert(spark, landing, options)
    _written(results)
    good = lake.read_dataset(spark, f"{target}/{kind.output_name}").select(
        "sample", F.lit("").alias("problem")
    )
    bad = spark.read.parquet(f"{aside}/{kind.output_name}")
    problem = F.when(F.array_contains("bad_columns", csv_scan.CORRUPT), csv_scan.CORRUPT).otherwise(
        F.array_join("bad_columns", ",")
    )
    both = good.unionByName(bad.select("sample", problem.alias("problem")))
    return both.groupBy("sample", "problem").agg(F.count("*").alias("n"))


@query(
    "q_sample_refresh",
    """
    SELECT CAST(c_custkey%20+1 AS INT) AS sample, COUNT(*) AS n,
      CAST(SUM(CAST(ROUND(c_acctbal*100) AS BIGINT)
        * CASE WHEN c_custkey%20+1 <= 5 THEN 2 ELSE 1 END) AS BIGINT) AS cents
    FROM customer GROUP BY 1
    """,
)
def sample_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Five samples are delivered again with doubled amounts; the others stay."""
    target = _members_lake(spark, folder)
    again, landing = _members(spark, folder), scratch(spark, "landing")
    doubled = again.withColumn("c_acctbal", F.round(F.col("c_acctbal") * 2, 2))
    deliver(doubled.where(_member_sample() <= 5), landing, BENE, _member_sample())
    lake_folder = target.rpartition("/")[0]
    results = convert.convert_deliveries(
        spark, landing, lake_folder, convert.Options(replace="samples")
    )
    _written(results)
    storage.delete_folder(spark, landing)
    rows = lake.read_dataset(spark, target)
    return rows.groupBy("sample").agg(
        F.count("*").alias("n"), F.sum(cents(F.col("c_acctbal"))).alias("cents")
    )


@query(
    "q_snapshot_refresh",
    """
    SELECT state, CAST(c_custkey%20+1 AS INT) AS sample, COUNT(*) AS n,
      CAST(SUM(CAST(ROUND(c_acctbal*100) AS BIGINT)
        * CASE WHEN state='after' AND c_custkey%20+1 <= 5 THEN 2 ELSE 1 END) AS BIGINT) AS cents
    FROM customer, (SELECT 'before' AS state UNION ALL SELECT 'after') states GROUP BY 1,2
    """,
)
def snapshot_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Five samples are refreshed in one step; the dataset as it was stays readable."""
    landing, again = scratch(spark, "landing"), scratch(spark, "landing")
    target, people = scratch(spark, "lake"), _members(spark, folder)
    deliver(people, landing, BENE, _member_sample())
    _written(convert.convert_deliveries(spark, landing, target, convert.Options(replace="snapshot")))
    path = f"{target}/{BENE.output_name}"
    before = lake.read_dataset(spark, path)
    doubled = people.withColumn("c_acctbal", F.round(F.col("c_acctbal") * 2, 2))
    deliver(doubled.where(_member_sample() <= 5), again, BENE, _member_sample())
    _written(convert.convert_deliveries(spark, again, target, convert.Options(replace="snapshot_samples")))
    storage.delete_folder(spark, landing)
    storage.delete_folder(spark, again)
    states = before.withColumn("state", F.lit("before")).unionByName(
        lake.read_dataset(spark, path).withColumn("state", F.lit("after"))
    )
    return states.groupBy("state", "sample").agg(F.count("*").alias("n"), F.sum(cents(F.col("c_acctbal"))).alias("cents"))


@query(
    "q_refresh_types",
    """
    SELECT CAST(c_custkey%20+1 AS INT) AS sample, 'double' AS stored, COUNT(*) AS n,
      CAST(SUM(CASE WHEN c_custkey%20+1 <= 5 THEN CAST(FLOOR(c_acctbal) AS BIGINT)*100
        ELSE CAST(ROUND(c_acctbal*100) AS BIGINT) END) AS BIGINT) AS cents
    FROM customer GROUP BY 1
    """,
)
def refresh_types(spark: SparkSession, folder: str) -> DataFrame:
    """Five samples are delivered again with whole amounts; the column stays a double."""
    target = _members_lake(spark, folder)
    landing = scratch(spark, "landing")
    whole = _members(spark, folder).withColumn("c_acctbal", F.floor("c_acctbal"))
    deliver(whole.where(_member_sample() <= 5), landing, BENE, _member_sample())
    _written(
        convert.convert_deliveries(
            spark, landing, target.rpartition("/")[0], convert.Options(replace="samples")
        )
    )
    storage.delete_folder(spark, landing)
    rows = lake.read_dataset(spark, target)
    return rows.groupBy("sample", F.typeof("c_acctbal").alias("stored")).agg(
        F.count("*").alias("n"), F.sum(cents(F.col("c_acctbal"))).alias("cents")
    )


@query(
    "q_refresh_empty_sample",
    """
    SELECT CAST(c_custkey%20+1 AS INT) AS sample, COUNT(*) AS n
    FROM customer WHERE c_custkey%20+1 <> 3 GROUP BY 1
    """,
)
def refresh_empty_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Sample 3 is delivered again without rows; it is empty then, and the others stay."""
    target = _members_lake(spark, folder)
    landing = scratch(spark, "landing")
    nothing = spark.createDataFrame([], _members(spark, folder).schema)
    nothing.write.option("header", True).csv(f"{landing}/{BENE.stem}_Sample_3.csv")
    _written(
        convert.convert_deliveries(
            spark, landing, target.rpartition("/")[0], convert.Options(replace="samples")
        )
    )
    storage.delete_folder(spark, landing)
    return lake.rows_per_sample(lake.read_dataset(spark, target))


@query(
    "q_quarantine_all_bad",
    """
    SELECT CAST(c_custkey%20+1 AS INT) AS sample, 'failed' AS status,
      COUNT(*) AS kept, COUNT(*) AS set_aside
    FROM customer GROUP BY 1
    """,
)
def quarantine_all_bad(spark: SparkSession, folder: str) -> DataFrame:
    """A delivery of which no row converts: set aside, and the old rows stay."""
    target = _members_lake(spark, folder)
    landing, aside = scratch(spark, "landing"), scratch(spark, "aside")
    bad = _members(spark, folder).withColumn("c_acctbal", F.lit("unknown"))
    deliver(bad, landing, BENE, _member_sample())
    options = convert.Options(schemas={BENE.name: _member_schema()}, quarantine=aside)
    results = convert.convert_deliveries(spark, landing, target.rpartition("/")[0], options)
    status = results.where(F.col("kind") == BENE.name).first()["status"]
    storage.delete_folder(spark, landing)
    kept = lake.read_dataset(spark, target).groupBy("sample").agg(F.count("*").alias("kept"))
    rejects = spark.read.parquet(f"{aside}/{BENE.output_name}")
    rejects = rejects.groupBy("sample").agg(F.count("*").alias("set_aside"))
    return kept.join(rejects, "sample", "full").withColumn("status", F.lit(status))


@query(
    "q_rejects_rerun",
    """
    SELECT CAST(o_custkey%20+1 AS INT) AS sample, COUNT(*) AS n
    FROM orders WHERE o_orderkey%7=0 AND o_custkey%20+1 > 5 GROUP BY 1
    """,
)
def rejects_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Five samples are delivered again without faults; only the others have rejects then."""
    aside, kind = scratch(spark, "aside"), KIND_BY_NAME["outpatient_claims"]
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    schemas = {kind.name: schema_for(["o_orderkey", "amount"], {"o_orderkey": "bigint", "amount": "double"})}

    def lines(rows: DataFrame, amount: Column) -> str:
        landing = scratch(spark, "landing")
        line = F.concat_ws(",", key.cast("string"), amount)
        deliver_lines(rows, "o_orderkey,amount", line, landing, kind, _key_sample("o_custkey"))
        return landing

    faulty = lines(orders, F.when(key % 7 == 0, "1d").otherwise("2.5"))
    target, results = _convert(spark, faulty, convert.Options(schemas=schemas, quarantine=aside))
    _written(results)
    clean = lines(orders.where(_key_sample("o_custkey") <= 5), F.lit("2.5"))
    options = convert.Options(schemas=schemas, quarantine=aside, replace="samples")
    _written(convert.convert_deliveries(spark, clean, target, options))
    storage.delete_folder(spark, clean)
    rejects = spark.read.parquet(f"{aside}/{kind.output_name}")
    return rejects.groupBy("sample").agg(F.count("*").alias("n"))


@query(
    "q_manifest_log",
    f"""
    SELECT DISTINCT '{BENE.stem}_Sample_' || (c_custkey%20+1) || '.csv' AS file_name,
      'landed' AS status, TRUE AS hashed FROM customer
    """,
)
def manifest_log(spark: SparkSession, folder: str) -> DataFrame:
    landing, log = scratch(spark, "landing"), scratch(spark, "log")
    deliver(_members(spark, folder), landing, BENE, _member_sample())
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(landing)
    )
    digests = lake.line_digests(spark, landing, "*.csv")
    lake.append_manifest(lake.file_manifest(files, "landed", digests), log)
    entries = spark.read.parquet(log)
    hashed = F.min((F.length("sha256") == 64) & (F.col("size_bytes") > 0)).alias("hashed")
    return entries.groupBy("file_name", "status").agg(hashed)


@query(
    "q_delivery_digest",
    """
    WITH l AS (SELECT c_custkey%20+1 AS sample,
        sha256(LPAD(CAST(c_custkey AS VARCHAR),9,'0') || ',' || c_name || ',' || c_mktsegment) AS h FROM customer),
      s AS (SELECT sample, COUNT(*) AS n,
        SUM(CAST('0x' || substr(h,1,15) AS BIGINT)) AS s0, SUM(CAST('0x' || substr(h,17,15) AS BIGINT)) AS s1,
        SUM(CAST('0x' || substr(h,33,15) AS BIGINT)) AS s2, SUM(CAST('0x' || substr(h,49,15) AS BIGINT)) AS s3
        FROM l GROUP BY 1)
    SELECT CAST(sample AS INT) AS sample, n, sha256(concat_ws(',', s0, s1, s2, s3, n)) AS digest FROM s
    """,
)
def delivery_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the rows of each delivered sample, however its part files are cut."""
    landing = scratch(spark, "landing")
    deliver(_members(spark, folder).select("cust_id", "c_name", "c_mktsegment"), landing, BENE, _member_sample())
    lines = spark.read.option("recursiveFileLookup", True).text(landing).where("value <> 'cust_id,c_name,c_mktsegment'")
    lines = lines.select(inventory.sample_of(F.col("_metadata.file_path")).alias("sample"), "value")
    return lines.groupBy("sample").agg(F.count("*").alias("n"), lake.multiset_digest(F.col("value")).alias("digest"))


@query(
    "q_claims_in_year",
    """
    SELECT o_orderkey, o_custkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS clm_thru_dt
    FROM orders WHERE EXTRACT(YEAR FROM o_orderdate) = 1997
    """,
)
def claims_in_year(spark: SparkSession, folder: str) -> DataFrame:
    """One year of claims out of a lake that is laid out by claim date within each sample."""
    rows = dated_claims(table(spark, folder, "orders"))
    target = f"{scratch(spark, 'lake')}/{CARRIER.output_name}"
    lake.write_dataset(lake.clustered(rows, "clm_thru_dt"), target, CARRIER.rows_per_file, "year")
    claims = lake.read_dataset(spark, target)
    return claims.where(dates.in_year(F.col("clm_thru_dt"), 1997)).select("o_orderkey", "o_custkey", "clm_thru_dt")


def dated_claims(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey", "o_custkey", dates.to_yyyymmdd(F.col("o_orderdate")).alias("clm_thru_dt"), _key_sample("o_custkey").alias("sample")
    )


@query(
    "q_rows_per_file",
    """
    SELECT CAST(o_custkey%20+1 AS INT) AS sample, COUNT(*) AS n, TRUE AS within, TRUE AS split
    FROM orders GROUP BY 1
    """,
)
def rows_per_file(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a sample hold at most the rows allowed, and there are as many as that takes."""
    target, most = f"{scratch(spark, 'lake')}/{CARRIER.output_name}", 500
    lake.write_dataset(dated_claims(table(spark, folder, "orders")), target, most, "capped")
    per_file = lake.read_dataset(spark, target).groupBy("sample", F.input_file_name().alias("file")).agg(F.count("*").alias("rows"))
    return per_file.groupBy("sample").agg(
        F.sum("rows").alias("n"), (F.max("rows") <= most).alias("within"), (F.count("*") >= F.ceil(F.sum("rows") / most)).alias("split")
    )


@query(
    "q_archive_names",
    f"SELECT DISTINCT '{BENE.stem}_Sample_' || (c_custkey%20+1) || '.zip' AS filename, TRUE AS filled FROM customer",
)
def archive_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names and sizes of the archives of a landing folder, which are not opened for that."""
    landing = _member_archives(spark, folder)
    found = inventory.archive_files(spark, f"{landing}/*")
    return found.groupBy("filename").agg((F.min("length") > 0).alias("filled"))


@query(
    "q_plan_bypass",
    f"""
    WITH {_manifest_sql()}, {_EVENT_ARCHIVES_SQL}
    SELECT 'missing' AS mode, filename FROM expected WHERE filename NOT IN (SELECT filename FROM found)
    UNION ALL SELECT 'validate', filename FROM expected UNION ALL SELECT 'again', filename FROM expected
    """,
)
def plan_bypass(spark: SparkSession, folder: str) -> DataFrame:
    """What is fetched when archives are skipped, only validated, or all fetched again."""
    wanted = manifest.expected_manifest(spark, manifest.pick_samples(everything=True))
    there = _event_archives(spark, folder)
    modes = {"missing": {}, "validate": {"validate_only": True}, "again": {"skip_existing": False}}
    plans = [manifest.plan_fetch(wanted, there, **how).select(F.lit(mode).alias("mode"), "filename") for mode, how in modes.items()]
    return plans[0].unionByName(plans[1]).unionByName(plans[2])


@query(
    "q_requested_samples",
    """
    WITH asked AS (SELECT n_nationkey AS place, CAST((n_nationkey*7)%12+1 AS INT) AS sample FROM nation),
      earliest AS (SELECT sample, MIN(place) AS place FROM asked GROUP BY 1),
      picked AS (SELECT sample, ROW_NUMBER() OVER (ORDER BY place)-1 AS no FROM earliest)
    SELECT sample, CAST(no*8 AS INT) AS first_position, CAST(8 AS BIGINT) AS archives FROM picked
    """,
)
def requested_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples asked for by nations, some of them twice: each once, in the order first asked for."""
    nations = table(spark, folder, "nation").orderBy("n_nationkey")
    asked = [r["s"] for r in nations.select((F.col("n_nationkey") * 7 % 12 + 1).cast("int").alias("s")).collect()]
    wanted = manifest.expected_manifest(spark, manifest.pick_samples(asked))
    return wanted.groupBy("sample").agg(F.min("position").alias("first_position"), F.count("*").alias("archives"))


@query(
    "q_drop_hindsight",
    """
    SELECT LPAD(CAST(c_custkey AS VARCHAR),9,'0') AS cust_id, c_mktsegment FROM customer
    """,
)
def drop_hindsight(spark: SparkSession, folder: str) -> DataFrame:
    """Features known at the index date: annual amounts, the death date and a named column go."""
    members = _members(spark, folder)
    yearly = {name: F.col("c_acctbal") for name in quality.ANNUAL_AMOUNTS}
    features = members.withColumns(yearly | {"BENE_DEATH_DT": F.lit(20100101)}).drop("c_name", "c_nationkey")
    return quality.drop_hindsight(features, ["c_acctbal"])


def zip_up(rows: DataFrame, kind: Kind, landing: str, damage: Callable[[int, bytes], bytes] | None = None) -> int:
    """Write rows (text cells and sample) as ZIP archives, a few per Arrow batch, from the tasks.

    `damage` may change the bytes of a sample's archives.
    """
    stem = kind.stem

    def pack(batches: Iterator) -> Iterator:
        import io
        import zipfile

        import pyarrow as pa
        from pyspark import TaskContext

        store, root = zips.store_of(landing, {})
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            cells = batch.to_pandas()
            folder = f"{root}/{task}-{number}"
            store.create_dir(folder, recursive=True)
            for sample, part in cells.groupby("sample"):
                name = f"{stem}_Sample_{sample}"
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(f"{name}.csv", part.drop(columns="sample").to_csv(index=False))
                content = held.getvalue() if damage is None else damage(int(sample), held.getvalue())
                with store.open_output_stream(f"{folder}/{name}.zip") as out:
                    out.write(content)
                yield pa.RecordBatch.from_pydict({"n": [1]})

    return rows.mapInArrow(pack, "n long").count()


def _member_archives(spark: SparkSession, folder: str, damage: Callable[[int, bytes], bytes] | None = None) -> str:
    cells = _members(spark, folder)
    text = cells.select(*[F.col(c).cast("string") for c in cells.columns], _member_sample().alias("sample"))
    landing = scratch(spark, "archives")
    zip_up(text, BENE, landing, damage)
    return landing


@query("q_zip_ingest", _PER_SAMPLE_SQL)
def zip_ingest(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch(spark, "lake")
    results = convert.convert_archives(
        spark, _member_archives(spark, folder), target, scratch(spark, "work")
    )
    _written(results)
    return lake.rows_per_sample(lake.read_dataset(spark, f"{target}/{BENE.output_name}"))


@query(
    "q_zip_rows",
    """
    SELECT LPAD(CAST(c_custkey AS VARCHAR(20)),9,'0') AS cust_id, c_name,
      CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
      CAST(c_custkey%20+1 AS INT) AS sample FROM customer
    """,
)
def zip_rows(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch(spark, "lake")
    found = _member_archives(spark, folder)
    options = convert.Options(infer="all")
    _written(convert.convert_archives(spark, found, target, scratch(spark, "work"), options, spread=8))
    return lake.read_dataset(spark, f"{target}/{BENE.output_name}")


@query(
    "q_archive_report",
    f"""
    SELECT DISTINCT '{BENE.stem}_Sample_' || (c_custkey%20+1) || '.csv' AS member,
      'extracted' AS status, TRUE AS has_bytes FROM customer
    """,
)
def archive_report(spark: SparkSession, folder: str) -> DataFrame:
    report = zips.archive_report(zips.members(spark, _member_archives(spark, folder)))
    members = report.select("status", "bytes", F.explode("members").alias("member"))
    return members.groupBy("member", "status").agg((F.sum("bytes") > 0).alias("has_bytes"))


@query(
    "q_zip_files",
    f"""
    SELECT '{BENE.stem}_Sample_' || (c_custkey%20+1) || '.csv' AS origin,
      'cust_id,c_name,c_nationkey,c_acctbal,c_mktsegment' AS header, COUNT(*) AS n FROM customer GROUP BY 1
    """,
)
def zip_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the archives that lie in a landing folder."""
    lines = zips.archive_lines(spark, _member_archives(spark, folder), batch_lines=100)
    return lines.groupBy("origin", "header").agg(F.count("line").alias("n"))


def _damaged(sample: int, content: bytes) -> bytes:
    """Every fifth sample's archives lack their end, every seventh's have a wrong byte in a member."""
    if sample % 5 == 0:
        return content[: len(content) // 2]
    if sample % 7 == 0:
        at = 30 + content[26] + 10
        return content[:at] + bytes([content[at] ^ 0xFF]) + content[at + 1 :]
    return content


@query(
    "q_zip_broken",
    f"""
    WITH c AS (SELECT c_custkey%20+1 AS s FROM customer), bad AS (SELECT s, s%5=0 OR s%7=0 AS broken FROM c)
    SELECT '{BENE.stem}_Sample_' || s || '.zip' AS filename,
      CASE WHEN broken THEN 'extract_failed' ELSE 'extracted' END AS status,
      CAST(COUNT(*) FILTER (NOT broken) AS BIGINT) AS n FROM bad GROUP BY ALL
    """,
)
def zip_broken(spark: SparkSession, folder: str) -> DataFrame:
    """Good and broken archives in one folder: all are reported, and the good ones are taken in."""
    landing, target = _member_archives(spark, folder, _damaged), scratch(spark, "lake")
    results = convert.convert_archives(spark, landing, target, scratch(spark, "work"))
    _written(results.where("status <> 'extract_failed'"))
    rows = lake.rows_per_sample(lake.read_dataset(spark, f"{target}/{BENE.output_name}"))
    report = zips.archive_report(zips.members(spark, landing)).select("filename", "status").distinct()
    name = F.concat(F.lit(f"{BENE.stem}_Sample_"), F.col("sample"), F.lit(".zip"))
    return report.join(rows.select(name.alias("filename"), "n"), "filename", "left").fillna(0, ["n"])


def _member_schema() -> T.StructType:
    return schema_for(
        ["cust_id", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        {"c_name": "string", "c_nationkey": "bigint", "c_acctbal": "double", "c_mktsegment": "string"},
    )


def _streamed(
    spark: SparkSession, folder: str, spoil: Column | None = None, quarantine: str | None = None
) -> tuple[str, str]:
    """Two landings, one after the other, each taken in by its own run of the same stream.

    Rows for which `spoil` holds are delivered with a nation that is no number.
    """
    landing, target = scratch(spark, "landing"), scratch(spark, "lake")
    checkpoint, log = scratch(spark, "stream"), scratch(spark, "log")
    people, sample = _members(spark, folder), _member_sample()
    if spoil is not None:
        nation = F.when(spoil, "n/a?").otherwise(F.col("c_nationkey").cast("string"))
        people = people.withColumn("c_nationkey", nation)
    for arrived in (sample <= 10, sample > 10):
        deliver(people.where(arrived), landing, BENE, sample)
        ingest.ingest_stream(
            spark, landing, BENE, _member_schema(), target, checkpoint, log, quarantine=quarantine
        ).awaitTermination()
    storage.delete_folder(spark, landing)
    return f"{target}/{BENE.output_name}", log


@query("q_stream_ingest", _PER_SAMPLE_SQL)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    target, _ = _streamed(spark, folder)
    return lake.rows_per_sample(ingest.read_streamed(spark, target))


@query(
    "q_stream_log",
    """
    SELECT 'beneficiary_2008' AS kind, CAST((c_custkey%20+1 > 10)::INT AS BIGINT) AS batch,
      COUNT(DISTINCT c_custkey%20+1) AS deliveries, COUNT(*) AS n, CAST(0 AS BIGINT) AS rejected
    FROM customer GROUP BY 1,2
    """,
)
def stream_log(spark: SparkSession, folder: str) -> DataFrame:
    _, log = _streamed(spark, folder)
    return _log_rows(spark, log)


def _log_rows(spark: SparkSession, log: str) -> DataFrame:
    batch = F.col(ingest.BATCH).cast("bigint").alias("batch")
    return spark.read.parquet(log).select("kind", batch, "deliveries", F.col("rows").alias("n"), "rejected")


_SPOILT = "c_custkey%20+1 <= 10 AND c_custkey%7 = 3"


@query(
    "q_stream_quarantine",
    f"""
    SELECT CAST(c_custkey%20+1 AS INT) AS sample, {_SPOILT} AS rejected,
      CASE WHEN {_SPOILT} THEN 'c_nationkey' ELSE '' END AS fault, COUNT(*) AS n
    FROM customer GROUP BY ALL
    """,
)
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The first landing has rows that do not convert: they are set aside, and the second run goes on."""
    aside = scratch(spark, "rejects")
    key = F.col("cust_id").cast("bigint")
    target, _ = _streamed(spark, folder, (_member_sample() <= 10) & (key % 7 == 3), aside)
    good = ingest.read_streamed(spark, target).select("sample", F.lit(False).alias("rejected"), F.lit("").alias("fault"))
    bad = spark.read.parquet(f"{aside}/{BENE.output_name}").select(
        "sample", F.lit(True).alias("rejected"), F.array_join("bad_columns", ",").alias("fault")
    )
    return good.unionByName(bad).groupBy("sample", "rejected", "fault").agg(F.count("*").alias("n"))


@query(
    "q_stream_reject_log",
    f"""
    SELECT 'beneficiary_2008' AS kind, CAST((c_custkey%20+1 > 10)::INT AS BIGINT) AS batch,
      COUNT(DISTINCT c_custkey%20+1) AS deliveries, COUNT(*) FILTER (NOT ({_SPOILT})) AS n,
      COUNT(*) FILTER ({_SPOILT}) AS rejected
    FROM customer GROUP BY 1,2
    """,
)
def stream_reject_log(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("cust_id").cast("bigint")
    _, log = _streamed(spark, folder, (_member_sample() <= 10) & (key % 7 == 3), scratch(spark, "rejects"))
    return _log_rows(spark, log)


@query("q_legacy_layout", _PER_SAMPLE_SQL)
def legacy_layout(spark: SparkSession, folder: str) -> DataFrame:
    hive = _members_lake(spark, folder)
    bare = scratch(spark, "bare")
    for sample in SAMPLES:
        if storage.path_exists(spark, f"{hive}/sample={sample}"):
            storage.move_folder(spark, f"{hive}/sample={sample}", f"{bare}/{sample}")
    return lake.rows_per_sample(lake.read_bare_dataset(spark, bare))

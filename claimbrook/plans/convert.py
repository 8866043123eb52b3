"""Deliveries to lake: one write job per dataset, one result row per dataset."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimbrook.functions.naming import DEFAULT_POLICY, CodePolicy
from claimbrook.functions.text_types import NullTokens
from claimbrook.sources import archives as zips
from claimbrook.sources import csv_scan, inventory, lake
from claimbrook.sources.kinds import KIND_BY_NAME, KINDS, Kind
from claimbrook.sources.storage import delete_folder

RESULT = (
    "kind string, status string, output_path string, row_count long, parquet_files long, "
    "partition_count long, column_count int, size_bytes long, rejected_rows long, detail string"
)


REPLACE = ("dataset", "in_place", "samples", "snapshot", "snapshot_samples")


@dataclass(frozen=True)
class Options:
    """How to convert.

    infer: 'first' types a dataset by its first delivery, 'all' by every delivery.
    schemas: stored schemas that are known, by dataset; those need no inference.
    quarantine: folder for rows that do not convert; None stops the dataset instead.
    replace: 'dataset' writes beside the old output and swaps the folders, 'in_place' adds the
    new files and then removes the old ones (for object stores, where a swap would copy),
    'samples' replaces only the samples delivered, in the types the dataset has already.
    'snapshot' and 'snapshot_samples' do the same as 'dataset' and 'samples' by a new version
    and one small file that names it, so that readers see the old or the new rows, never both.
    at_once: datasets converted at the same time.
    """

    policy: CodePolicy = DEFAULT_POLICY
    nulls: NullTokens = NullTokens()
    infer: str = "first"
    schemas: dict[str, T.StructType] | None = None
    quarantine: str | None = None
    replace: str = "dataset"
    at_once: int = 1
    report_missing: bool = True

    def __post_init__(self) -> None:
        if self.infer not in ("first", "all"):
            raise ValueError("infer is 'first' or 'all'")
        if self.replace not in REPLACE:
            raise ValueError("replace is one of " + ", ".join(REPLACE))


def _set_aside(
    spark: SparkSession, rejected: DataFrame, bad: int, kind: Kind, samples: Sequence[int], o: Options
) -> None:
    """Put the rejects of this run in the place of those of an earlier one."""
    aside = f"{o.quarantine}/{kind.output_name}"
    stale = [f"{aside}/{lake.PARTITION}={s}" for s in samples] if o.replace.endswith("samples") else [aside]
    for folder in stale:
        delete_folder(spark, folder)
    if bad:
        # A second look at the deliveries, only taken when there is something to set aside.
        rejected.write.mode("append").partitionBy(lake.PARTITION).parquet(aside)


def _write_typed(
    spark: SparkSession, raw: DataFrame, schema: T.StructType, kind: Kind, target: str, samples: Sequence[int], o: Options
) -> dict:
    """Type, write and inspect one dataset. Only this runs over the rows."""
    seen = Observation()
    if o.quarantine is None:
        rows = csv_scan.typed_rows(raw, schema, o.nulls).observe(
            seen, F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("bad")
        )
    else:
        checked = csv_scan.checked_rows(raw, schema, o.nulls)
        watched = checked.observe(
            seen,
            F.count("*").alias("rows"),
            F.count_if(F.size(csv_scan.BAD_COLUMNS) > 0).alias("bad"),
        )
        rows = csv_scan.good_rows(watched)

    def check() -> None:
        """Before the old output goes: rejects are set aside, and some row has to be good."""
        counts = seen.get
        if o.quarantine is not None:
            _set_aside(spark, csv_scan.rejected_rows(checked), counts["bad"], kind, samples, o)
        if counts["bad"] and counts["bad"] == counts["rows"]:
            raise ValueError(f"no row converts: all {counts['bad']} rows were set aside")

    if o.replace == "samples":
        lake.refresh_samples(rows, target, kind.rows_per_file, uuid.uuid4().hex, samples, check)
    elif o.replace.startswith("snapshot"):
        others = o.replace == "snapshot_samples"
        lake.publish_dataset(rows, target, kind.rows_per_file, uuid.uuid4().hex, samples, check, others)
    elif o.replace == "in_place":
        lake.overwrite_dataset(rows, target, kind.rows_per_file, samples, check)
    else:
        lake.write_dataset(rows, target, kind.rows_per_file, uuid.uuid4().hex, samples, check)
    found = {"rejected_rows": seen.get["bad"], "column_count": len(schema.fields)}
    return found | lake.inspect_dataset(spark, target).first().asDict()


def _run(kind: Kind, target: str, work: Callable[[], dict]) -> tuple:
    """One result row; an error in one dataset does not reach the next one."""
    try:
        r = work()
        return (
            kind.name, "written", target, r["row_count"], r["parquet_files"],
            r["partition_count"], r["column_count"], r["size_bytes"], r["rejected_rows"], "",
        )
    except Exception as error:
        return (kind.name, "failed", target, 0, 0, 0, 0, 0, 0, str(error))


def _skipped(kind: Kind) -> tuple:
    return (kind.name, "skipped", None, 0, 0, 0, 0, 0, 0, "no deliveries")


def _run_all(
    spark: SparkSession, works: dict[str, tuple[str, Callable[[], dict]]], o: Options, more: Sequence[tuple] = ()
) -> DataFrame:
    """Run the datasets in their order and report them in it, at most seven rows, then `more`."""

    def one(kind: Kind) -> tuple | None:
        if kind.name in works:
            return _run(kind, *works[kind.name])
        return _skipped(kind) if o.report_missing else None

    with ThreadPoolExecutor(max(1, o.at_once)) as pool:
        rows = [r for r in pool.map(one, KINDS) if r is not None]
    return spark.createDataFrame([*rows, *more], RESULT)


def _known_schema(spark: SparkSession, kind: Kind, target: str, o: Options) -> T.StructType | None:
    """The schema that needs no inference: that of the dataset to be refreshed, or the one given."""
    stored = lake.stored_schema(spark, target) if o.replace.endswith("samples") else None
    return stored or (o.schemas or {}).get(kind.name)


def _schema(
    raw_of: Callable, sources: Sequence[str], header: list[str], known: T.StructType | None, o: Options
) -> T.StructType:
    if known:
        if known.fieldNames() != header:
            raise csv_scan.HeaderError(f"{sources[0]}: {csv_scan.header_problem(header, known.fieldNames())}")
        return known
    wanted = list(sources) if o.infer == "all" else [sources[0]]
    return csv_scan.infer_schema(raw_of(wanted), header, o.policy, o.nulls)


def convert_deliveries(
    spark: SparkSession, landing: str, lake_folder: str, options: Options | None = None
) -> DataFrame:
    """CSV deliveries of a landing folder to Parquet datasets partitioned by sample."""
    o = options or Options()
    found: dict[str, list[str]] = {}
    # Bounded: names are unique in a folder and samples are range-checked.
    for row in inventory.artifacts(inventory.file_inventory(spark, landing)).collect():
        found.setdefault(row["kind"], []).append((row["location"], row["sample"]))

    def work(kind: Kind, delivered: list[tuple[str, int]], target: str) -> dict:
        locations = [location for location, _ in delivered]
        header = csv_scan.require_one_header(csv_scan.read_headers(spark, locations))

        def raw_of(some: Sequence[str]) -> DataFrame:
            return csv_scan.raw_csv(spark, some, header)

        schema = _schema(raw_of, locations, header, _known_schema(spark, kind, target, o), o)
        samples = sorted({sample for _, sample in delivered})
        return _write_typed(spark, raw_of(locations), schema, kind, target, samples, o)

    works = {}
    for name, delivered in found.items():
        kind = KIND_BY_NAME[name]
        target = f"{lake_folder}/{kind.output_name}"
        works[name] = (
            target,
            lambda k=kind, x=delivered, t=target: work(k, x, t),
        )
    return _run_all(spark, works, o)


def convert_archives(
    spark: SparkSession,
    landing: str,
    lake_folder: str,
    work_folder: str,
    options: Options | None = None,
    spread: int | None = None,
    **source,
) -> DataFrame:
    """ZIP archives of a landing folder to the same datasets.

    Lines are decoded once into a Parquet table in the work folder, so inference, checks
    and writing use all cores whatever the sizes of the members; a lost executor costs
    a few members. `spread` redistributes the decoded lines by their hash first, for few
    big members. An archive that is broken anywhere is left out whole and has a result row
    of its own (its name, extract_failed, the reason); the others are converted. `source`
    are options of the data source.
    """
    o = options or Options()
    stage = f"{work_folder}/lines-{uuid.uuid4().hex}"
    try:
        return _convert_lines(spark, zips.archive_lines(spark, landing, **source), lake_folder, stage, o, spread)
    finally:
        delete_folder(spark, stage)


def _convert_lines(
    spark: SparkSession, decoded: DataFrame, lake_folder: str, stage: str, o: Options, spread: int | None
) -> DataFrame:
    named = inventory.parse_names(decoded.withColumn("file_name", F.col("origin")))
    kept = named.where("problem is not null or reject_reason is null")
    kept = kept.select("kind", "archive", "sample", "part", "origin", "header", "line", "problem")
    if spread:
        kept = kept.repartition(spread, F.xxhash64("line", "origin"))
    kept.write.partitionBy("kind").parquet(stage)
    stored = spark.read.schema(kept.select(*kept.columns[1:], "kind").schema).parquet(stage)
    broken = stored.where("problem is not null").groupBy("archive").agg(F.min("problem").alias("problem"))
    whole = stored.join(broken, "archive", "left_anti")
    # One row per dataset: the first member in read order, and whether all headers agree.
    order = F.struct("sample", F.coalesce("part", F.lit("")).alias("part"), "origin", "header")
    per_kind = whole.where("line is null").groupBy("kind").agg(
        F.min(order).alias("first"), F.min("header").alias("low"), F.max("header").alias("high"),
        F.sort_array(F.collect_set("sample")).alias("samples"),
    )
    heads = {row["kind"]: row for row in per_kind.collect()}
    left_out = [
        (row["archive"].rsplit("/", 1)[-1], "extract_failed", None, 0, 0, 0, 0, 0, 0, row["problem"])
        for row in broken.orderBy("archive").collect()
    ]

    def work(kind: Kind, target: str) -> dict:
        head = heads[kind.name]
        if head["low"] != head["high"]:
            raise csv_scan.HeaderError("archive members have different headers")
        header = csv_scan.split_header(head["first"]["header"])
        problem = csv_scan.header_problem(header, header)
        if problem:
            raise csv_scan.HeaderError(problem)
        lines = whole.where((F.col("kind") == kind.name) & F.col("line").isNotNull())

        def raw_of(origins: Sequence[str]) -> DataFrame:
            return csv_scan.raw_lines(lines.where(F.col("origin").isin(list(origins))), header)

        everything = csv_scan.raw_lines(lines, header)
        known = _known_schema(spark, kind, target, o)
        if o.infer == "all" and not known:
            schema = csv_scan.infer_schema(everything, header, o.policy, o.nulls)
        else:
            schema = _schema(raw_of, [head["first"]["origin"]], header, known, o)
        return _write_typed(spark, everything, schema, kind, target, head["samples"], o)

    works = {}
    for name in heads:
        kind = KIND_BY_NAME[name]
        target = f"{lake_folder}/{kind.output_name}"
        works[name] = (target, lambda k=kind, t=target: work(k, t))
    return _run_all(spark, works, o, left_out)


def conversion_summary(results: DataFrame) -> DataFrame:
    """Datasets written, failed and skipped."""
    return results.agg(
        F.count_if(F.col("status") == "written").alias("successful_datasets"),
        F.count_if(F.col("status") == "failed").alias("failed_datasets"),
        F.count_if(F.col("status") == "skipped").alias("skipped_datasets"),
    )


def delivery_summary(results: DataFrame, status: str = "status", size: str = "bytes") -> DataFrame:
    """Counts over archive results (validated, skipped, extracted, download_failed,
    extract_failed), in one pass."""
    s = F.col(status)
    return results.agg(
        F.count("*").alias("total_files"),
        F.count_if(s == "skipped").alias("skipped_files"),
        F.count_if(~s.eqNullSafe("skipped")).alias("attempted_files"),
        F.count_if(s.isin("extracted", "extract_failed")).alias("successful_downloads"),
        F.count_if(s == "download_failed").alias("failed_downloads"),
        F.count_if(s == "extracted").alias("successful_extractions"),
        F.count_if(s == "extract_failed").alias("failed_extractions"),
        F.count_if(s == "validated").alias("validated_files"),
        F.count_if((s == "download_failed") & (F.col(size) == 0)).alias("failed_validations"),
    )


def delivery_failures(results: DataFrame, status: str = "status") -> DataFrame:
    return results.where(F.col(status).isin("download_failed", "extract_failed"))

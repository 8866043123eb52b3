"""Newly landed CSV deliveries of one dataset, appended to the lake once each.

Ingest is stateless, so there is no watermark. A micro-batch owns the folders
sample=<n>/batch=<id> in the lake and, where rows that do not convert are set aside, the same
folders among the rejects: it empties its own folders and writes both outputs again after a
failure, and the same holds for its row in the log, so every delivery counts once and one bad
cell does not stop the deliveries after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimbrook.functions.text_types import NullTokens
from claimbrook.sources import csv_scan
from claimbrook.sources.inventory import delivery_name, parse_names
from claimbrook.sources.kinds import Kind
from claimbrook.sources.storage import child_folders, delete_folder

BATCH = "ingest_batch"


def delivered_stream(
    spark: SparkSession, landing: str, kind: Kind, header: list[str], max_files: int | None = None
) -> DataFrame:
    """Text cells of all deliveries of a dataset, as a stream.

    The glob finds files and folder deliveries alike; names are checked again per row.
    """
    reader = (
        spark.readStream.schema(csv_scan.text_schema(header))
        .options(**csv_scan.DIALECT)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(f"{landing}/*{kind.stem}_Sample_*.csv")
    rows = rows.withColumn(csv_scan.ORIGIN, F.col("_metadata.file_path"))
    named = parse_names(rows.withColumn("_name", delivery_name(F.col(csv_scan.ORIGIN))), "_name")
    accepted = named.where((F.col("kind") == kind.name) & F.col("reject_reason").isNull())
    return accepted.select(*header, csv_scan.CORRUPT, csv_scan.ORIGIN)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    kind: Kind,
    schema: T.StructType,
    lake_folder: str,
    checkpoint: str,
    log: str | None = None,
    nulls: NullTokens = NullTokens(),
    max_files: int | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start an ingest that takes what has landed so far and stops.

    The stored schema has to be given, since a stream cannot infer it. Without a quarantine
    folder a row that does not convert stops the stream; with one it is set aside with its
    origin, the columns at fault and its text.
    """
    raw = delivered_stream(spark, landing, kind, schema.fieldNames(), max_files)
    target = f"{lake_folder}/{kind.output_name}"
    aside = f"{quarantine}/{kind.output_name}" if quarantine else None

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        # A batch has at most one delivery for each sample and half, or part files of these.
        counted = [
            F.collect_set(delivery_name(F.col(csv_scan.ORIGIN))).alias("deliveries"),
            F.count("*").alias("rows"),
        ]
        if aside is None:
            watched = batch.observe(seen, *counted, F.lit(0).cast("bigint").alias("rejected"))
            good = csv_scan.typed_rows(watched, schema, nulls)
        else:
            checked = csv_scan.checked_rows(batch, schema, nulls)
            bad = F.size(csv_scan.BAD_COLUMNS) > 0
            good = csv_scan.good_rows(checked.observe(seen, *counted, F.count_if(bad).alias("rejected")))
        _write_owned(good, target, batch_id, kind.rows_per_file)
        found = seen.get
        if aside is not None:
            rejected = csv_scan.rejected_rows(checked) if found["rejected"] else None
            _write_owned(rejected, aside, batch_id, kind.rows_per_file)
        if log:
            entry = (kind.name, batch_id, len(found["deliveries"]), found["rows"] - found["rejected"], found["rejected"])
            _write_log(batch.sparkSession, entry, log)

    return (
        raw.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _write_owned(rows: DataFrame | None, target: str, batch_id: int, rows_per_file: int) -> None:
    """Put rows (or none) in the place of what a batch has written before."""
    spark = rows.sparkSession if rows is not None else SparkSession.active()
    for folder in child_folders(spark, target):
        if folder.startswith("sample="):
            delete_folder(spark, f"{target}/{folder}/{BATCH}={batch_id}")
    if rows is None:
        return
    (
        rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .write.mode("append")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("sample", BATCH)
        .parquet(target)
    )


def _write_log(spark: SparkSession, entry: tuple, log: str) -> None:
    """One row per dataset and batch: deliveries, rows taken in, rows set aside."""
    row = spark.createDataFrame([entry], f"kind string, {BATCH} bigint, deliveries bigint, rows bigint, rejected bigint")
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", BATCH).parquet(log)


def read_streamed(spark: SparkSession, target: str) -> DataFrame:
    """A streamed dataset without the batch column, as a batch conversion has it."""
    return spark.read.parquet(target).drop(BATCH)

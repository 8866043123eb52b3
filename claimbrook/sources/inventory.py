"""What has been delivered: CSV files and ZIP archives of a landing folder.

A delivery is a file named <stem>_Sample_<n>.csv, or a folder of part files with that
name (also as delivery=<name>, the way a partitioned Spark write lays it out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimbrook.sources.kinds import KINDS, SAMPLES, kinds_table
from claimbrook.sources.storage import list_entries

DELIVERY_NAME = r"(?:^|[/=])([^/=]+\.csv)(?:/[^/]*)?$"
_PARTS = r"^(\w+?)_Sample_(\d+)([AB]?)\.csv$"
_SAMPLE_IN_PATH = r"_Sample_(\d+)[AB]?\.csv(?:/[^/]*)?$"
_LISTING = "path string, file_name string, length bigint, files bigint"


def csv_deliveries(spark: SparkSession, landing: str) -> DataFrame:
    """CSV files and folder deliveries of a landing folder, by path; none if it is missing."""
    rows = [
        (path, name.rpartition("=")[2], length, files)
        for path, name, length, files in list_entries(spark, landing, "*.csv")
    ]
    return spark.createDataFrame(rows, _LISTING)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """ZIP archives of a folder with their names and sizes."""
    rows = [(p, name, length) for p, name, length, _ in list_entries(spark, folder, "*.zip")]
    return spark.createDataFrame(rows, "path string, filename string, length bigint")


def delivery_name(path: Column) -> Column:
    return F.regexp_extract(path, DELIVERY_NAME, 1)


def sample_of(path: Column) -> Column:
    """Sample number out of the path of an accepted delivery, for tagging its rows."""
    return F.regexp_extract(path, _SAMPLE_IN_PATH, 1).try_cast("int")


def parse_names(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Add kind, sample, part and reject_reason, read off the (case-exact) name."""
    stem = F.regexp_extract(name, _PARTS, 1)
    number = F.regexp_extract(name, _PARTS, 2).try_cast("int")
    half = F.regexp_extract(name, _PARTS, 3)
    # Halves are part of the name of some datasets only; '*' stands for either of them.
    known = [x for k in KINDS for x in (F.lit(k.stem + "*" * k.halves), F.lit(k.name))]
    spelled = F.concat(stem, F.when(half == "", "").otherwise("*"))
    kind = F.try_element_at(F.create_map(*known), spelled)
    in_range = F.coalesce(number.between(SAMPLES[0], SAMPLES[-1]), F.lit(False))
    return files.withColumns(
        {
            "kind": kind,
            "sample": F.when(kind.isNotNull(), number),
            "part": F.when(kind.isNotNull() & (half != ""), half),
            "reject_reason": F.when(kind.isNull(), "unrecognised file name").when(
                ~in_range, "sample out of range"
            ),
        }
    )


def file_inventory(spark: SparkSession, landing: str) -> DataFrame:
    """Every delivery with its parsed name, rejected ones with the reason."""
    return parse_names(csv_deliveries(spark, landing)).select(
        "path", "file_name", "length", "files", "kind", "sample", "part", "reject_reason"
    )


def artifacts(inventory: DataFrame) -> DataFrame:
    """Accepted deliveries by dataset, in the order they are read.

    At most kinds x samples x halves rows, as names are unique in a folder.
    """
    accepted = inventory.where("reject_reason is null")
    return accepted.select(
        "kind", "sample", "part", "file_name", F.col("path").alias("location"), "files", "length"
    ).orderBy("kind", *read_order())


def read_order() -> list[Column]:
    """Samples by number, then halves; a delivery without halves comes first."""
    return [F.col("sample"), F.coalesce(F.col("part"), F.lit("")), F.col("file_name")]


def group_by_kind(inventory: DataFrame) -> DataFrame:
    """Accepted deliveries per dataset, in dataset order; datasets without any are absent."""
    accepted = inventory.where("reject_reason is null")
    counted = accepted.groupBy("kind").agg(
        F.count("*").alias("files"),
        F.countDistinct("sample").alias("samples"),
        F.min(
            F.struct("sample", F.coalesce("part", F.lit("")).alias("part"), "file_name")
        ).alias("first"),
    )
    return (
        counted.join(F.broadcast(kinds_table(counted.sparkSession)), "kind")
        .select("rank", "kind", "output_name", "files", "samples", F.col("first.file_name").alias("first_file"))
        .orderBy("rank")
    )

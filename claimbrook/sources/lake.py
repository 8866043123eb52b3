"""The Parquet lake: one folder per dataset, partitioned by sample.

A dataset may be kept as snapshots instead: its rows lie in version=<id>/sample=<n> folders,
and the numbered files in _snapshots say which folders are the dataset. The newest one counts,
and creating it is a single write of a small file, so a reader sees all of the old rows or all
of the new ones, whatever fails and whenever it looks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimbrook.sources.inventory import delivery_name
from claimbrook.sources.storage import (
    child_folders,
    create_text,
    data_files,
    delete_files,
    delete_folder,
    list_entries,
    read_text,
    replace_folder,
)

PARTITION = "sample"
VERSION = "version"
SNAPSHOTS = "_snapshots"


def staging_folder(target: str, tag: str) -> str:
    """A folder next to the target, on the same file system, hidden from readers."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_staging-{tag}/{name}"


def _writer(df: DataFrame, rows_per_file: int, mode: str):
    return (
        df.write.mode(mode)
        .partitionBy(PARTITION)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
    )


def fill_samples(df: DataFrame, folder: str, samples: Sequence[int]) -> None:
    """Give each delivered sample without rows a file that has the schema and no rows, so
    that a dataset can be read whatever was delivered."""
    spark = df.sparkSession
    have = child_folders(spark, folder)
    fields = [f for f in df.schema.fields if f.name != PARTITION]
    for sample in samples:
        if f"{PARTITION}={sample}" not in have:
            empty = spark.createDataFrame([], T.StructType(fields))
            empty.write.mode("overwrite").parquet(f"{folder}/{PARTITION}={sample}")


def write_dataset(
    df: DataFrame,
    target: str,
    rows_per_file: int,
    tag: str,
    samples: Sequence[int] = (),
    check: Callable[[], None] | None = None,
) -> None:
    """Replace a dataset. All rows are written beside it first, so nothing is lost when
    a row fails or `check` raises; then the folders are swapped."""
    staged = staging_folder(target, tag)
    try:
        _writer(df, rows_per_file, "overwrite").parquet(staged)
        if check:
            check()
        fill_samples(df, staged, samples)
        replace_folder(df.sparkSession, staged, target)
    finally:
        delete_folder(df.sparkSession, staged.rpartition("/")[0])


def overwrite_dataset(
    df: DataFrame,
    target: str,
    rows_per_file: int,
    samples: Sequence[int] = (),
    check: Callable[[], None] | None = None,
) -> None:
    """Replace a dataset in its place, for stores where moving a folder copies its files.

    New files are committed next to the old ones and the old ones are removed last: after a
    bad row or a raising `check` the new ones are removed again. A reader may see both for a
    moment, and if the driver dies in between; `publish_dataset` does not have that gap.
    """
    spark = df.sparkSession
    old = data_files(spark, target)
    folders = child_folders(spark, target)
    try:
        _writer(df, rows_per_file, "append").parquet(target)
        if check:
            check()
        # Samples whose folder holds nothing but old files need a file of their own too.
        kept = set(data_files(spark, target)) - set(old)
    except Exception:
        delete_files(spark, sorted(set(data_files(spark, target)) - set(old)))
        raise
    filled = {f.rsplit("/", 2)[-2] for f in kept}
    empty = [s for s in samples if f"{PARTITION}={s}" not in filled]
    delete_files(spark, old)
    for folder in folders:
        if folder not in filled:
            delete_folder(spark, f"{target}/{folder}")
    fill_samples(df, target, empty)


def refresh_samples(
    df: DataFrame,
    target: str,
    rows_per_file: int,
    tag: str,
    samples: Sequence[int] = (),
    check: Callable[[], None] | None = None,
) -> None:
    """Replace the samples given and those in df, also by nothing; the others stay as they
    are. Rows are written beside the dataset first, then the samples' folders are swapped
    one by one."""
    spark = df.sparkSession
    staged = staging_folder(target, tag)
    try:
        _writer(df, rows_per_file, "overwrite").parquet(staged)
        if check:
            check()
        fill_samples(df, staged, samples)
        for folder in child_folders(spark, staged):
            if folder.startswith(f"{PARTITION}="):
                replace_folder(spark, f"{staged}/{folder}", f"{target}/{folder}")
    finally:
        delete_folder(spark, staged.rpartition("/")[0])


def snapshot_number(spark: SparkSession, target: str) -> int | None:
    """Number of a dataset's newest snapshot; None if it is not kept as snapshots."""
    names = [name for _, name, _, _ in list_entries(spark, f"{target}/{SNAPSHOTS}", "*.json")]
    return max((int(name.partition(".")[0]) for name in names), default=None)


def snapshot_folders(spark: SparkSession, target: str, number: int) -> dict[int, str]:
    """Folder of each sample, relative to the dataset."""
    held = json.loads(read_text(spark, f"{target}/{SNAPSHOTS}/{number:012d}.json"))
    return {int(sample): folder for sample, folder in held.items()}


def publish_dataset(
    df: DataFrame,
    target: str,
    rows_per_file: int,
    tag: str,
    samples: Sequence[int] = (),
    check: Callable[[], None] | None = None,
    keep_others: bool = False,
) -> int:
    """Write rows as a new version and make it the dataset; the number of the snapshot.

    With keep_others the samples that are neither given nor in df stay as they are. Old
    versions stay for their readers until `drop_old_versions`. Of two writers at the same
    time one fails, since a snapshot's file is only ever created. A dataset that was written
    without snapshots and is still there keeps its samples by reference.
    """
    spark = df.sparkSession
    number = snapshot_number(spark, target)
    held: dict[int, str] = {}
    if keep_others and number is not None:
        held = snapshot_folders(spark, target, number)
    elif keep_others:
        mark = f"{PARTITION}="
        held = {int(f[len(mark) :]): f for f in child_folders(spark, target) if f.startswith(mark)}
    version = f"{VERSION}={tag}"
    try:
        _writer(df, rows_per_file, "overwrite").parquet(f"{target}/{version}")
        if check:
            check()
        fill_samples(df, f"{target}/{version}", samples)
        written = [f for f in child_folders(spark, f"{target}/{version}") if f.startswith(f"{PARTITION}=")]
        held |= {int(f.partition("=")[2]): f"{version}/{f}" for f in written}
        new = 0 if number is None else number + 1
        create_text(spark, f"{target}/{SNAPSHOTS}/{new:012d}.json", json.dumps(held, sort_keys=True))
    except Exception:
        delete_folder(spark, f"{target}/{version}")
        raise
    return new


def drop_old_versions(spark: SparkSession, target: str, keep: int = 1) -> None:
    """Remove folders that none of the `keep` newest snapshots names, and older snapshots."""
    newest = snapshot_number(spark, target)
    if newest is None:
        return
    numbers = range(max(0, newest - keep + 1), newest + 1)
    named = {folder for n in numbers for folder in snapshot_folders(spark, target, n).values()}
    for n in range(numbers[0]):
        delete_folder(spark, f"{target}/{SNAPSHOTS}/{n:012d}.json")
    for folder in child_folders(spark, target):
        if folder.startswith(f"{PARTITION}=") and folder not in named:
            delete_folder(spark, f"{target}/{folder}")
        elif folder.startswith(f"{VERSION}="):
            inside = child_folders(spark, f"{target}/{folder}")
            for sample in inside:
                if f"{folder}/{sample}" not in named:
                    delete_folder(spark, f"{target}/{folder}/{sample}")
            if not any(f"{folder}/{sample}" in named for sample in inside):
                delete_folder(spark, f"{target}/{folder}")


def stored_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """The schema a dataset has, without its sample; None if there is no dataset."""
    if not data_files(spark, target):
        return None
    fields = read_dataset(spark, target).schema.fields
    return T.StructType([f for f in fields if f.name != PARTITION])


def read_dataset(
    spark: SparkSession, path: str, samples: Sequence[int] | None = None, number: int | None = None
) -> DataFrame:
    """A dataset with its sample column; naming samples reads only their folders.

    Of a dataset kept as snapshots, the newest is read, or the one whose number is given.
    """
    number = snapshot_number(spark, path) if number is None else number
    if number is None:
        rows = spark.read.parquet(path)
    else:
        # Folders with and without a version have different partition columns.
        held: dict[bool, list[str]] = {}
        for folder in snapshot_folders(spark, path, number).values():
            held.setdefault("/" in folder, []).append(f"{path}/{folder}")
        parts = [spark.read.option("basePath", path).parquet(*folders).drop(VERSION) for folders in held.values()]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows if samples is None else rows.where(F.col(PARTITION).isin(list(samples)))


def read_bare_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A dataset whose folders are bare sample numbers (<path>/1/part-0.parquet)."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/[^/]+$", 1)
    return rows.withColumn(PARTITION, number.cast("int"))


def rows_per_sample(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy(PARTITION).agg(F.count("*").alias("n")).orderBy(PARTITION)


def inspect_dataset(spark: SparkSession, path: str) -> DataFrame:
    """One row on a written dataset: files, rows, columns, partitions, bytes.

    No data column is read: rows are counted per file, then files are added up.
    """
    rows = read_dataset(spark, path)
    columns = [c for c in rows.columns if c != PARTITION]
    per_file = rows.groupBy(
        PARTITION,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    ).agg(F.count("*").alias("n"))
    return per_file.agg(
        F.lit(path).alias("path"),
        F.count("*").alias("parquet_files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        F.lit(PARTITION).alias("partition_columns"),
        F.size(F.collect_set(PARTITION)).cast("bigint").alias("partition_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
    )


def clustered(rows: DataFrame, column: str, files: int | None = None) -> DataFrame:
    """Rows laid out by ranges of a column within each sample, for writing as a dataset.

    Each task then writes a narrow range of few samples, sorted, so the statistics of its row
    groups rule most of them out for a filter on the column. One shuffle, dealt by sampled
    ranges of sample, column and a hash of the row, so that neither a large sample nor one
    frequent value lands in a single task.
    """
    spread = F.xxhash64(*[c for c in rows.columns if c != PARTITION])
    order = [F.col(PARTITION), F.col(column), spread]
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return dealt.sortWithinPartitions(PARTITION, column)


def multiset_digest(value: Column) -> Column:
    """An aggregate: sha256 over how many values there are and the sums of four pieces of their
    own digests. It does not depend on their order, and repeated values count."""
    h = F.sha2(value, 256)
    pieces = [F.conv(F.substring(h, 16 * i + 1, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = [F.coalesce(F.sum(p), F.lit(0)).cast("string") for p in pieces]
    return F.sha2(F.concat_ws(",", *sums, F.count(value).cast("string")), 256)


def line_digests(spark: SparkSession, landing: str, glob: str = "*") -> DataFrame:
    """(path, sha256, lines) of the text files below a folder, whatever their size.

    A file is read in splits by many tasks, and only sums meet. Its digest does not depend on
    the order of the lines or on how they end.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(landing)
    named = lines.select(F.col("_metadata.file_path").alias("path"), "value")
    return named.groupBy("path").agg(multiset_digest(F.col("value")).alias("sha256"), F.count("*").alias("lines"))


def file_manifest(files: DataFrame, status: str, digests: DataFrame | None = None) -> DataFrame:
    """Log rows for files of a binaryFile listing: delivery, part, size, status, time.

    Their content is not read; `digests` (path, sha256, lines) adds those of each file, which
    are null for a file without lines.
    """
    if digests is not None:
        plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
        known = digests.select(plain(F.col("path")).alias("_path"), "sha256", "lines")
        files = files.join(known, plain(F.col("path")) == F.col("_path"), "left")
    part = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.coalesce(F.nullif(delivery_name(F.col("path")), F.lit("")), part).alias("file_name"),
        part.alias("part_name"),
        F.col("length").alias("size_bytes"),
        F.lit(status).alias("status"),
        F.col("modificationTime").alias("modified"),
        *(["sha256", "lines"] if digests is not None else []),
    )


def append_manifest(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)

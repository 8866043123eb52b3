"""ZIP archives of a folder as rows: a data source whose partitions are runs of members.

Planning lists the folder and reads each archive's directory of members, which lies at its
end, so large archives are dealt out by member before any of them is decoded. Every archive,
whatever its size, is opened the same way: by pyarrow's file systems, which take their
settings from the `uri_options` option (`region=eu-west-1&endpoint_override=...`) and a
scheme's other name from `schemes` (`s3a=s3`). Members are decoded as a stream in small
batches, so neither a member nor its lines are ever held whole.

An archive that cannot be listed, or a member that cannot be decoded to its end, gives a row
that says so, and the others go on.
"""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "zip_members"
MEMBERS = "archive string, ordinal int, member string, status string, detail string, bytes long"
LINES = "archive string, origin string, header string, line string, problem string"
RUN_BYTES = 64 * 1024 * 1024
LEAST_RUNS = 16
BATCH_LINES = 20_000


def store_of(uri: str, options: dict[str, str]):
    """(file system, path in it) of a location."""
    from pyarrow import fs

    scheme, mark, rest = uri.partition(":/")
    if not mark or scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if mark else uri
    names = dict(pair.split("=") for pair in options.get("schemes", "s3a=s3").split(",") if pair)
    given = options.get("uri_options", "")
    return fs.FileSystem.from_uri(f"{names.get(scheme, scheme)}:/{rest}" + (f"?{given}" if given else ""))


def unsafe(name: str) -> bool:
    """A member that would be unpacked outside its folder."""
    parts = name.replace("\\", "/").split("/")
    return name.startswith(("/", "\\")) or ".." in parts or ":" in parts[0]


@dataclass
class Member:
    archive: str
    ordinal: int
    name: str | None
    size: int
    problem: str | None = None


@dataclass
class Run(InputPartition):
    members: list[Member]


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = dict(options)

    def _directory(self, archive: str) -> list[Member]:
        store, _ = store_of(self.options["path"], self.options)
        try:
            with store.open_input_file(archive) as file, zipfile.ZipFile(file) as held:
                found = [i for i in held.infolist() if not i.is_dir()]
        except Exception as error:
            return [Member(archive, 0, None, 0, str(error) or type(error).__name__)]
        return [Member(archive, n, i.filename, i.file_size) for n, i in enumerate(found)] or [Member(archive, 0, None, 0)]

    def partitions(self) -> list[Run]:
        from pyarrow import fs

        store, root = store_of(self.options["path"], self.options)
        inside = store.get_file_info(fs.FileSelector(root, recursive=True))
        archives = sorted(f.path for f in inside if f.type == fs.FileType.File and f.path.endswith(".zip"))
        with ThreadPoolExecutor(int(self.options.get("threads", 16))) as pool:
            members = [m for found in pool.map(self._directory, archives) for m in found]
        # Small members share a task; one larger than a run has its own.
        # A folder of less than that many runs is dealt out too.
        fair = sum(m.size for m in members) // int(self.options.get("least_runs", LEAST_RUNS))
        most, runs, held = min(int(self.options.get("run_bytes", RUN_BYTES)), fair), [], 0
        for member in members:
            if not runs or held + member.size > most:
                runs.append(Run([]))
                held = 0
            runs[-1].members.append(member)
            held += member.size
        # Spark makes a partition of nothing where a plan has none.
        return runs or [Run([])]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.options["path"], self.options)
        one = self.lines if self.options.get("rows") == "lines" else self.report
        for member in partition.members:
            yield from one(store, member)

    def report(self, store, member: Member) -> Iterator[pa.RecordBatch]:
        """A row for a member, decoded to its end, which checks its checksum too."""
        status, detail, size = "extracted", member.problem or "", 0
        if member.problem is not None:
            status = "extract_failed"
        elif member.name is not None and unsafe(member.name):
            status = "rejected"
        elif member.name is not None:
            try:
                with store.open_input_file(member.archive) as file, zipfile.ZipFile(file) as held, held.open(member.name) as stream:
                    while chunk := stream.read(1 << 20):
                        size += len(chunk)
            except Exception as error:
                status, detail = "extract_failed", str(error) or type(error).__name__
        columns = [member.archive, member.ordinal, member.name, status, detail, size]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c], k) for c, k in zip(columns, kinds)], names=["archive", "ordinal", "member", "status", "detail", "bytes"]
        )

    def lines(self, store, member: Member) -> Iterator[pa.RecordBatch]:
        """Filled lines of a CSV member. One row without a line comes first, so that a member
        without lines is not forgotten; one with a problem comes last where there is one."""
        names = ["archive", "origin", "header", "line", "problem"]
        origin = member.name.rsplit("/", 1)[-1] if member.name else None

        def batch(header: str | None, rows: list, problem: str | None = None) -> pa.RecordBatch:
            same = [pa.repeat(pa.scalar(x, pa.string()), len(rows)) for x in (member.archive, origin, header, problem)]
            return pa.RecordBatch.from_arrays([*same[:3], pa.array(rows, pa.string()), same[3]], names=names)

        if member.problem is not None:
            yield batch(None, [None], member.problem)
        if member.name is None or unsafe(member.name) or not member.name.endswith(".csv"):
            return
        header, rows = None, []
        try:
            with store.open_input_file(member.archive) as file, zipfile.ZipFile(file) as held, held.open(member.name) as raw:
                for line in io.TextIOWrapper(raw, encoding="utf-8-sig", newline="\n"):
                    line = line.rstrip("\r\n")
                    if not line.strip():
                        continue
                    if header is None:
                        header = line
                        yield batch(header, [None])
                        continue
                    rows.append(line)
                    if len(rows) == int(self.options.get("batch_lines", BATCH_LINES)):
                        yield batch(header, rows)
                        rows = []
            if header is None:
                yield batch("", [None])
            elif rows:
                yield batch(header, rows)
        except Exception as error:
            yield batch(header, [None], str(error) or type(error).__name__)


class ZipMembers(DataSource):
    """spark.read.format("zip_members").load(folder); `rows` is 'members' or 'lines'."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES if self.options.get("rows") == "lines" else MEMBERS

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def _load(spark: SparkSession, folder: str, rows: str, options: dict) -> DataFrame:
    # The classes travel with the job, so workers need nothing installed.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ZipMembers)
    return spark.read.format(FORMAT).option("rows", rows).options(**options).load(folder)


def members(spark: SparkSession, folder: str, **options) -> DataFrame:
    """One row per member: extracted, rejected (an unsafe name) or extract_failed."""
    return _load(spark, folder, "members", options)


def archive_report(found: DataFrame) -> DataFrame:
    """One row per archive out of its members: extracted or extract_failed, bytes, names."""
    named = F.col("member").isNotNull()
    listed = lambda kept: F.transform(
        F.array_sort(F.collect_list(F.when(named & kept, F.struct("ordinal", "member")))), lambda m: m["member"]
    )
    failed = F.col("status") == "extract_failed"
    return found.groupBy(F.col("archive").alias("path")).agg(
        F.element_at(F.split(F.first("archive"), "/"), -1).alias("filename"),
        F.when(F.bool_or(failed), "extract_failed").otherwise("extracted").alias("status"),
        F.coalesce(F.min_by("detail", F.when(failed, F.col("ordinal"))), F.lit("")).alias("detail"),
        F.sum("bytes").alias("bytes"),
        listed(F.col("status") != "rejected").alias("members"),
        listed(F.col("status") == "rejected").alias("rejected"),
    )


def archive_lines(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Filled lines of all CSV members, each with its archive, member and header line."""
    return _load(spark, folder, "lines", options)

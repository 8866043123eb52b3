"""Folder operations on whatever file system Spark reads: exists, swap, delete."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, location: str) -> bool:
    fs, path = _path(spark, location)
    return bool(fs.exists(path))


def list_entries(
    spark: SparkSession, folder: str, glob: str, threads: int = 8
) -> list[tuple[str, str, int, int]]:
    """(path, name, bytes, files) of what lies directly in a folder, files and folders.

    A folder counts as one entry: its size is asked of the file system in one call, so
    the driver holds a row per delivery and not per part file.
    """
    fs, path = _path(spark, f"{folder}/{glob}")

    def entry(status) -> tuple[str, str, int, int]:
        where = status.getPath()
        if status.isFile():
            return where.toString(), where.getName(), status.getLen(), 1
        inside = fs.getContentSummary(where)
        return where.toString(), where.getName(), inside.getLength(), inside.getFileCount()

    with ThreadPoolExecutor(threads) as pool:
        return sorted(pool.map(entry, fs.globStatus(path) or []))


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders that lie directly in a folder; none if it does not exist."""
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the visible files below a folder; none if it does not exist."""
    fs, path = _path(spark, folder)
    out = []
    if fs.exists(path):
        found = fs.listFiles(path, True)
        while found.hasNext():
            where = found.next().getPath()
            if not where.getName().startswith(("_", ".")):
                out.append(where.toString())
    return out


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _path(spark, source)
    _, dst = _path(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def move_children(spark: SparkSession, source: str, target: str) -> None:
    """Move the folders inside a folder up into another one, and drop what is left."""
    fs, path = _path(spark, source)
    for status in fs.listStatus(path):
        if status.isDirectory():
            child = status.getPath()
            move_folder(spark, child.toString(), f"{target}/{child.getName()}")
    delete_folder(spark, source)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of an older one.

    The older one is set aside first and put back when the move fails, so a reader finds
    the old or the new data, and a failed write leaves the old.
    """
    previous = None
    if path_exists(spark, target):
        parent, _, name = target.rstrip("/").rpartition("/")
        previous = f"{parent}/_previous-{uuid.uuid4().hex}/{name}"
        move_folder(spark, target, previous)
    try:
        move_folder(spark, staged, target)
    except Exception:
        if previous:
            move_folder(spark, previous, target)
        raise
    if previous:
        fs, old = _path(spark, previous)
        fs.delete(old.getParent(), True)


def delete_folder(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    if fs.exists(path):
        fs.delete(path, True)


def delete_files(spark: SparkSession, locations: list[str]) -> None:
    for location in locations:
        fs, path = _path(spark, location)
        if not fs.delete(path, False):
            raise OSError(f"could not delete {location}")


def create_text(spark: SparkSession, location: str, text: str) -> None:
    """Write a small new file; an error if there is one of that name already."""
    fs, path = _path(spark, location)
    stream = fs.create(path, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, location: str) -> str:
    fs, path = _path(spark, location)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()

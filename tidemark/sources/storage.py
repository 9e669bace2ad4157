"""The few file-system calls the tables need, through Hadoop so that any store works."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import SparkSession

DELETES_AT_ONCE = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match ``pattern``, sorted; empty when nothing does."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return sorted(s.getPath().toString() for s in found) if found else []


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path that an encoded URI, such as Spark's file names, stands for."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there is one. What cannot be deleted is an error."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
    if fs.exists(p):
        raise OSError(f"could not delete {path}")


def delete_all(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete any number of folders, of which few are in memory at a time."""
    paths = iter(paths)
    with ThreadPoolExecutor(DELETES_AT_ONCE) as pool:
        while some := list(islice(paths, 64 * DELETES_AT_ONCE)):
            list(pool.map(lambda path: delete(spark, path), some))


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of the last change."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def make_temporary(spark: SparkSession, path: str) -> None:
    """Create a folder that goes away with the driver."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def size(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path``, 0 where there is nothing."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def move(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder to a place that is free. Nothing happens when it has been moved there before; a rename
    onto a folder that exists would end inside that and is refused."""
    fs, p = _fs(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(target):
        if fs.exists(p):
            raise OSError(f"could not move {path}: {to} exists")
        return
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"could not move {path} to {to}")

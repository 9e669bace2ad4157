"""Durable intermediate tables on the cluster's shared folder.

A table written here cuts the lineage and survives the loss of any executor, unlike a cached or
locally checkpointed frame.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import storage


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


class Scratch:
    """Writes frames under one private folder and hands back the frames read from it."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{(root or shared_dir(spark)).rstrip('/')}/tidemark-{uuid.uuid4()}"
        self._n = 0
        storage.make_temporary(spark, self.path)

    def table(self, df: DataFrame, partition_cols: list[str] | None = None) -> DataFrame:
        """``df``, written down; rows of other values in ``partition_cols`` (few) need not be read together."""
        self._n += 1
        path = f"{self.path}/{self._n}"
        writer = df.write.partitionBy(*partition_cols) if partition_cols else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])

    def drop(self) -> None:
        storage.delete(self.spark, self.path)


def bytes_of(df: DataFrame) -> Column:
    """Upper estimate of the in-memory bytes of a row."""
    size = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size += F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(F.col(f"`{f.name}`")))
            size += F.coalesce(F.octet_length(text), F.lit(0)) * 2 + 32
        else:
            size += 16
    return size.cast("long")


def measure(df: DataFrame) -> tuple[int, int]:
    """Exact row count and an upper estimate of the in-memory bytes, in one pass."""
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(bytes_of(df)), F.lit(0))).first()
    return row[0], row[1]


# Shuffle partitions are planned for this many stored (compressed) bytes each.
STORED_BYTES_PER_PARTITION = 64 << 20


@contextmanager
def enough_partitions(spark: SparkSession, stored_bytes: int):
    """Raise ``spark.sql.shuffle.partitions`` to fit the data at hand, so that a shuffle of it does
    not spill; AQE merges what turns out too small. Never lowers the setting."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = -(-stored_bytes // STORED_BYTES_PER_PARTITION)
    if wanted > int(before):
        spark.conf.set(key, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Of a write into folders, each task sorts its rows by folder: so much of the input is read, and so much of the
# shuffled rows sorted, by one task. Both are compressed, and many times as much in memory.
SORTED_BYTES_READ, SORTED_BYTES = 32 << 20, 16 << 20


@contextmanager
def small_sorts(spark: SparkSession):
    """Bound the rows that one task sorts, whatever the size of the whole. Never raises the settings."""
    limits = {"spark.sql.files.maxPartitionBytes": SORTED_BYTES_READ, "spark.sql.adaptive.advisoryPartitionSizeInBytes": SORTED_BYTES}
    before = {key: spark.conf.get(key) for key in limits}
    for key, most in limits.items():
        spark.conf.set(key, str(min(most, _bytes(before[key]))))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _bytes(text: str) -> int:
    """A size as Spark's settings have it, in bytes unless a unit says otherwise."""
    found = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", text.strip().lower())
    return int(found[1]) << 10 * " kmgtp".index(found[2] or " ")

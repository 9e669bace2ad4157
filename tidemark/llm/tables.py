"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tidemark.scratch import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Limit Arrow batches of the session to ``rows``, because each row holds a whole text; a lower limit
    stays. It bounds the memory of Python workers and of the buffers that feed them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def new_folder(spark: SparkSession, label: str) -> str:
    """URI of a fresh folder below the shared folder, for files that tasks write themselves."""
    root = shared_dir(spark)
    return f"{root if '://' in root else 'file://' + root}/{label}-{uuid.uuid4()}"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, in the driver or in a task."""
    return fs.FileSystem.from_uri(uri)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of it with underscores before it that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name

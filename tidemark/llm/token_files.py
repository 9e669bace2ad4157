"""Token-id files: flat unsigned integers with 64-bit document offsets.

One part per range of doc_id: ``<part>.bin`` holds the ids of its documents one after another,
``<part>.off`` holds n + 1 little-endian 64-bit positions (in ids, within the part) and ``<part>.doc``
the n document ids as 64-bit integers. Tasks that are retried write under other names; the manifest, a
Parquet table with one row per committed part, says which files count and where each part begins among
all ids: the prefix sum of the sizes of the parts before it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.encoder import encoder
from tidemark.llm.tables import open_store

NO_ID = -(1 << 63)  # stands for a null doc_id in a .doc file
_ROWS = 2_000


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 2) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into ``folder``; returns the manifest.

    Null or empty text: only the end id. A null doc_id comes first. Rows with equal doc_id are all kept,
    ordered by a hash of their text. Other columns are ignored. No rows: no part.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], dtype=enc.dtype).tobytes()
        store, root = open_store(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        ids_file = None
        sizes, ids = [], []
        for batch in batches:
            if batch.num_rows and ids_file is None:
                ids_file = store.open_output_stream(f"{root}/{name}.bin")
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                for data in enc.encode(some.column(1).to_pylist()):
                    ids_file.write(data + end)
                    sizes.append((len(data) + len(end)) // enc.dtype.itemsize)
                ids.append(some.column(0).fill_null(NO_ID).to_numpy().astype("<i8"))
        if ids_file is None:
            return
        ids_file.close()
        offsets = np.concatenate([[0], np.cumsum(np.array(sizes, dtype="<i8"))]).astype("<i8")
        for suffix, values in (("off", offsets), ("doc", np.concatenate(ids))):
            with store.open_output_stream(f"{root}/{name}.{suffix}") as out:
                out.write(values.tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "name": [name], "width": [enc.dtype.itemsize],
             "n_docs": [len(sizes)], "n_ids": [int(offsets[-1])]},
            pa.schema([("part", pa.int32()), ("name", pa.string()), ("width", pa.int32()),
                       ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    ordered.mapInArrow(write, "part int, name string, width int, n_docs long, n_ids long").write.parquet(
        f"{folder}/parts"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = spark.read.parquet(f"{folder}/parts")
    parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(
        f"{folder}/manifest"
    )
    return spark.read.parquet(f"{folder}/manifest")


def _mapped(store: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where the store is local, read otherwise."""
    if not store.get_file_info(path).size:
        return np.empty(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=dtype)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of a token folder: doc_id, start among all ids, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), and the ids themselves where asked for."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for row in (r for b in batches for r in b.to_pylist()):
            stem = f"{root}/{row['name']}"
            ids = _mapped(store, f"{stem}.bin", f"<u{row['width']}")
            offsets = _mapped(store, f"{stem}.off", "<i8")
            docs = _mapped(store, f"{stem}.doc", "<i8")
            for at in range(0, len(docs), _ROWS):
                cut = offsets[at : at + _ROWS + 1]
                some = [ids[a:b].astype("<u4") for a, b in zip(cut[:-1], cut[1:])]
                columns = [
                    pa.array(docs[at : at + _ROWS], mask=docs[at : at + _ROWS] == NO_ID),
                    pa.array(cut[:-1] + row["base"]),
                    pa.array(np.diff(cut)),
                    pa.array([zlib.crc32(x.tobytes()) for x in some], pa.int64()),
                ] + [pa.array([x.astype("i8") for x in some], pa.list_(pa.int64()))] * with_ids
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    parts = manifest.count()
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return manifest.repartition(max(1, parts)).mapInArrow(read, out)

"""Near-duplicates by SimHash, found with multi-index hashing.

Two fingerprints within three bits differ by at most one bit in one of their 32-bit halves. So each
different fingerprint is filed under both halves, and looks under each half as it is and with one bit
set (of two halves that differ in one bit, one turns into the other by setting it): 34 lookups on
average, and whole distances are verified on what they fetch. Of a half that very many fingerprints
share, the 16-bit quarters of the other half are filed in turn and searched in the same way, all of
whose single-bit changes are looked up; 48 bits are then fixed, which bounds such a list by 65,536.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.scratch import Scratch

MAX_BITS = 3
LONG_LIST = 64  # fingerprints under one half from which its other half is filed too
LOW = 0xFFFFFFFF


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of the word shingles (repeats included) of a text, A-Z lower-cased; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(n, 8), axis=1)
    on = bits.sum(axis=0, dtype=np.int64) * 2 > n
    return int.from_bytes(np.packbits(on).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long, of every row; null text has no words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.astype(np.int64))], names=["doc_id", "fp"]
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(hashed, "doc_id long, fp long")


def as_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def _half(fp: Column, side: Column) -> Column:
    return F.when(side == 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(LOW))


def _quarter(half: Column, side: Column) -> Column:
    return F.when(side == 0, F.shiftright(half, 16)).otherwise(half.bitwiseAND(0xFFFF))


def _flipped(value: Column, bits: int, only_set: bool) -> Column:
    """The value itself and it with one of its low bits changed, or only set."""
    masks = F.array(*[F.lit(1 << k).cast("long") for k in range(bits)])
    if only_set:
        masks = F.filter(masks, lambda m: value.bitwiseAND(m) == 0)
    return F.concat(F.array(value), F.transform(masks, lambda m: value.bitwiseXOR(m)))


def near_links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (u, v) between all different fingerprints (column ``fp``, no repeats) within three bits;
    a link may come more than once."""
    sides = F.explode(F.array(F.lit(0), F.lit(1)))
    halves = prints.select("fp", sides.alias("side")).select("fp", "side", _half(F.col("fp"), F.col("side")).alias("half"))
    long = scratch.table(
        halves.groupBy("side", "half").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LONG_LIST).select("side", "half")
    )
    filed = halves.select(F.col("fp").alias("v"), "side", "half")
    looks = halves.select(
        F.col("fp").alias("u"), "side", F.explode(_flipped(F.col("half"), 32, only_set=True)).alias("half")
    )
    near = (F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS)
    short = looks.join(filed.join(long, ["side", "half"], "left_anti"), ["side", "half"]).filter(near)

    def quarters(lists: DataFrame, name: str) -> DataFrame:
        other = _half(F.col(name), 1 - F.col("side"))
        return lists.join(long, ["side", "half"]).withColumn("second", sides).withColumn(
            "quarter", _quarter(other, F.col("second"))
        )

    deep = quarters(looks, "u").withColumn(
        "quarter", F.explode(_flipped(F.col("quarter"), 16, only_set=False))
    ).join(quarters(filed, "v"), ["side", "half", "second", "quarter"]).filter(near)
    return short.select("u", "v").union(deep.select("u", "v"))


def near_duplicates(docs: DataFrame, shingle: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, ``fp`` and ``component_id`` of every row of ``docs`` (doc_id, text).

    Rows are linked when their fingerprints differ in at most three bits (texts without words all have
    fingerprint 0); a component's id is its smallest doc_id. Rows with a null doc_id take part and
    never name a component that has another row. Other columns are dropped, repeated rows kept.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    hashed = scratch.table(fingerprints(docs, shingle))
    prints = scratch.table(hashed.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    labels = components(near_links(prints.select("fp"), scratch), scratch)
    labelled = prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp")
    )
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = scratch.table(labelled.join(least, "label").select("fp", "component_id"))
    return hashed.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_firsts(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the component_id that ``named`` gives them, all columns kept; of
    rows equal in doc_id and text, one. Rows with a null doc_id stay as they are."""
    firsts = named.filter("doc_id = component_id").select("doc_id").distinct()
    known = docs.filter("doc_id IS NOT NULL").join(firsts, "doc_id", "left_semi")
    once = known.dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return once.unionByName(docs.filter("doc_id IS NULL"))


def keep_one(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, as ``keep_firsts`` keeps them."""
    return keep_firsts(docs, near_duplicates(docs, scratch=scratch))

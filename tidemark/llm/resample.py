"""Resampling of documents towards a target distribution by importance weights.

Texts are bags of hashed n-grams. A bucket's gain is the logarithm of how much likelier the target is to
use it than the documents are, a document's weight the sum of the gains of its features, and the draw
without replacement is by weight plus Gumbel noise. The cut is found by bisection: exact counts over the
written scores narrow the score, then the ids that share it, to one place; only what is drawn is then
ranked, by range partitions and the sums of those before each.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.scratch import Scratch

POINTS = 15  # thresholds counted in one job: four halvings at once
LAST = (1 << 63) - 1
# digits, small letters and everything beyond ASCII stay, capitals become small, the rest parts words
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


def buckets_of(words: list[bytes], buckets: int) -> np.ndarray:
    """Bucket of every run of one to three consecutive words; a checksum goes on where that of the run
    without its last word ended."""
    spaced = [b" " + w for w in words]
    one = list(map(crc32, words))
    two = list(map(crc32, spaced[1:], one))
    three = map(crc32, spaced[2:], two)
    found = np.fromiter(chain(one, two, three), np.uint32) % np.uint32(buckets)
    return found.astype("<u2" if buckets <= 1 << 16 else "<u4")


def featured(docs: DataFrame, buckets: int) -> DataFrame:
    """row, doc_id, n_words, n_features and the buckets of all features of each text, as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features = [], []
            for text in batch.column(2).cast(pa.binary()):
                found = words_of(text.as_py())
                words.append(len(found))
                features.append(buckets_of(found, buckets).tobytes())
            size = 2 if buckets <= 1 << 16 else 4
            counts = [len(x) // size for x in features]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(features, pa.binary())],
                names=["row", "doc_id", "n_words", "n_features", "buckets"],
            )

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(run, "row long, doc_id long, n_words long, n_features long, buckets binary")


def _flat(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch, and where each row's begin (and the last one's end)."""
    size = 2 if buckets <= 1 << 16 else 4
    rows = column.to_pylist()
    ends = np.cumsum([0] + [len(x) // size for x in rows])
    return np.frombuffer(b"".join(rows), f"<u{size}"), ends


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; every task sends one number per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0), buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    sums = features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed shares in the target and in the source."""
    n = len(source)
    in_source, in_target = float(source.sum() + n), float(target.sum() + n)
    return np.array(
        [math.floor(1000 * math.log(((t + 1.0) * in_source) / ((s + 1.0) * in_target))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def noise_of(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, in thousandths; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    """``features`` with weight and score in place of the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _flat(batch.column(4), len(gains))
            sums = np.concatenate([[0], np.cumsum(gains[flat])])[ends]
            weight = np.diff(sums)
            noise = np.array([noise_of(x, seed) for x in batch.column(1).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(weight), pa.array(weight + noise)],
                names=["row", "doc_id", "n_words", "n_features", "weight", "score"],
            )

    return features.mapInArrow(run, "row long, doc_id long, n_words long, n_features long, weight long, score long")


def value_at(frame: DataFrame, key: Column, place: int) -> tuple[int, int]:
    """The value of the integer ``key`` at a place (from 1) in ascending order, and how many rows have a
    smaller one: bisection with exact counts, a few thresholds to a job."""
    low, high = frame.agg(F.min(key), F.max(key)).first()
    below = 0
    while low < high:
        step = -(-(high - low + 1) // (POINTS + 1))
        points = list(range(low + step - 1, high, step))
        counts = frame.agg(*[F.count_if(key <= p) for p in points]).first()
        for p, n in zip(points, counts):
            if n >= place:
                high = p
                break
            low, below = p + 1, n
    return low, below


def first_rows(frame: DataFrame, keys: list[Column], wanted: int) -> Column:
    """Condition that holds for the ``wanted`` first rows by ``keys``, longs of which no two rows share all."""
    equal, chosen = F.lit(True), F.lit(False)
    for key in keys:
        value, below = value_at(frame.filter(equal), key, wanted)
        wanted -= below
        chosen = chosen | (equal & (key < value))
        equal = equal & (key == value)
    return chosen | equal


def ranked(spark: SparkSession, chosen: DataFrame, keys: list[Column], scratch: Scratch) -> DataFrame:
    """``chosen`` with ``rank`` by ``keys``: range partitions, numbered after the sizes of those before."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.table(chosen.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()))
    sizes = sorted(tuple(r) for r in dealt.groupBy("part").count().collect())  # one row per partition
    bases = np.cumsum([0] + [n for _, n in sizes]).tolist()
    before = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, bases)], "part int, base long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    return dealt.join(F.broadcast(before), "part").withColumn("rank", F.col("base") + place).drop("part", "base")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (long doc_id, text): doc_id, n_features, weight, score and, for the
    ``percent`` of the documents of at least ``least_words`` words that are drawn, rank from 1.

    All texts of both tables are counted. Ties go to the smaller doc_id (null last), repeated rows of one
    id follow one another in rank. Null and empty texts have no features, weight 0, and are never drawn;
    an empty target makes all documents lean to rare features; empty ``docs`` give no rows. Other columns
    are not looked at. Driver and tasks hold ``buckets`` numbers, whatever the size of the tables.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    features = scratch.table(featured(docs, buckets))
    wanted = scratch.table(featured(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets))
    gains = gains_of(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    scores = scratch.table(scored(features, gains, seed))
    columns = ["doc_id", "n_features", "weight", "score"]
    able = scores.filter(F.col("n_words") >= least_words)
    n_drawn = percent * able.count() // 100
    undrawn = F.lit(None).cast("long").alias("rank")
    if not n_drawn:
        return scores.select(*columns, undrawn)
    keys = [-F.col("score"), F.coalesce("doc_id", F.lit(LAST)), F.col("row")]
    chosen = (F.col("n_words") >= least_words) & first_rows(able, keys, n_drawn)
    drawn = ranked(spark, scores.filter(chosen), keys, scratch).select(*columns, F.col("rank").cast("long"))
    return scores.filter(~chosen).select(*columns, undrawn).unionByName(drawn)

"""Packing of token pieces into sequences of a fixed capacity, by patterns of few documents.

The histogram of piece lengths (at most ``capacity`` rows) is all the driver sees. Lengths are put in
coarse bins, all patterns of two to four bins that fill a sequence are enumerated, and non-negative
least squares finds how often to repeat each so that together they use up the histogram. Rounded
down, each pattern is carried out with the exact lengths at hand; what remains is packed best-fit by
decreasing length, still as counts and not piece by piece. The resulting slots are handed out by the
rank of a piece among those of its length, which needs no group in one task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encoder import encoder
from tidemark.scratch import Scratch

BINS = 128
_ROWS = 2_000
_PIECES_PER_BUCKET = 5_000


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None = 0, with_ids: bool = False
) -> DataFrame:
    """Encoded pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 and, where
    asked for, ids (little-endian unsigned 32-bit). Null text is empty; without an end id an empty
    text gives no piece. Repeated rows give repeated pieces, other columns are ignored."""
    types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
             "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if with_ids else {})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], dtype=enc.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                rows = defaultdict(list)
                for doc_id, data in zip(
                    some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())
                ):
                    ids = np.frombuffer(data + end, dtype=enc.dtype).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        raw = ids[start : start + capacity].tobytes()
                        values = (doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), raw)
                        for name, value in zip(types, values):
                            rows[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[n], t) for n, t in types.items()], schema=pa.schema(types.items())
                )

    out = "doc_id long, piece int, start long, length long, ids_crc32 long"
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(cut, out + ", ids binary" * with_ids)


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lawson and Hanson's active-set method: x >= 0 that minimises |a x - b|. Its solution has at most
    as many entries above zero as ``a`` has rows, so that rounding it down loses little."""
    x = np.zeros(a.shape[1])
    used = np.zeros(a.shape[1], dtype=bool)
    for _ in range(3 * a.shape[0] + 10):
        gradient = a.T @ (b - a @ x)
        gradient[used] = -np.inf
        best = int(np.argmax(gradient)) if len(gradient) else 0
        if not len(gradient) or gradient[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        used[best] = True
        while True:
            columns = np.flatnonzero(used)
            solved = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[columns] = solved
                break
            low = solved <= 0
            now = x[columns]
            step = np.min(now[low] / np.maximum(now[low] - solved[low], 1e-300))
            x[columns] = np.maximum(now + step * (solved - now), 0)
            drop = columns[(x[columns] <= 1e-12) & low]
            used[drop] = False
            x[drop] = 0
            if not used.any():
                break
    return x


def _patterns(present: np.ndarray, total: int) -> list[tuple[int, ...]]:
    """Multisets of two to four present bins that sum to ``total``, largest bin first."""
    there = set(present.tolist())
    found = []
    for a in present:
        if total - a in there and total - a <= a:
            found.append((a, total - a))
        for b in present[present <= a]:
            rest = total - a - b
            if rest in there and rest <= b:
                found.append((a, b, rest))
            for c in present[(present <= b) & (present < rest)]:
                if rest - c in there and rest - c <= c:
                    found.append((a, b, c, rest - c))
    return found


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in order, how many alike) that hold exactly the histogram's pieces."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} has no place in {capacity}")
        left[length] = n
    done = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    bins = min(BINS, capacity)
    of = np.clip(np.rint(np.arange(capacity + 1) * bins / capacity), 1, bins - 1).astype(int)
    coarse = np.bincount(of, weights=left, minlength=bins)
    patterns = _patterns(np.flatnonzero(coarse), bins) if bins > 1 else []
    opened: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    if patterns:
        a = np.zeros((bins, len(patterns)))
        for k, pattern in enumerate(patterns):
            np.add.at(a[:, k], list(pattern), 1)
        repeats = np.floor(non_negative_least_squares(a, coarse)).astype(int)
        lengths_of = [np.flatnonzero(of == k) for k in range(bins)]
        for k in np.argsort(-repeats, kind="stable"):
            wanted = int(repeats[k])
            while wanted > 0 and (exact := _exact(patterns[k], left, lengths_of, capacity)):
                uses = {x: exact.count(x) for x in exact}
                n = min([wanted] + [int(left[x]) // m for x, m in uses.items()])
                for x, m in uses.items():
                    left[x] -= n * m
                opened[capacity - sum(exact)].append((exact, n))
                wanted -= n
    spaces = np.zeros(capacity + 1, dtype=bool)
    spaces[list(opened)] = True
    for length in range(capacity - 1, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(spaces[length:])
            if not len(fits):
                each = capacity // length
                for copies, times in ((each, n // each), (n % each, 1)):
                    if copies and times:
                        opened[capacity - copies * length].append(((length,) * copies, times))
                        spaces[capacity - copies * length] = True
                break
            space = length + int(fits[0])
            held, times = opened[space].pop()
            taken = min(n, times)
            if taken < times:
                opened[space].append((held, times - taken))
            spaces[space] = bool(opened[space])
            opened[space - length].append((held + (length,), taken))
            spaces[space - length] = True
            n -= taken
    return done + [g for space in sorted(opened) for g in opened[space]]


def _exact(pattern, left, lengths_of, capacity) -> tuple[int, ...] | None:
    """Lengths at hand, one per bin of the pattern, that fit one sequence and fill it well."""
    for pick in (-1, 0):  # the longest of each bin, or else the shortest
        chosen: list[int] = []
        space = capacity
        for k, of in enumerate(pattern):
            free = [x for x in lengths_of[of] if left[x] > chosen.count(x) and x <= space]
            if not free:
                break
            chosen.append(int(free[-1 if k == len(pattern) - 1 else pick]))
            space -= chosen[-1]
        if len(chosen) == len(pattern):
            return tuple(chosen)
    return None


def pack(pieces: DataFrame, capacity: int, scratch: Scratch | None = None) -> DataFrame:
    """Adds sequence_id and offset to pieces (with a ``length`` of 1 to ``capacity``), as few sequences
    as the plan finds; offsets run without gaps from 0. Pieces of the same length are interchangeable:
    which of them gets which slot follows a hash of the row. No pieces: an empty table."""
    spark = pieces.sparkSession
    scratch = scratch or Scratch(spark)
    pieces = scratch.table(pieces)
    names = pieces.columns
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    total = sum(histogram.values())
    slots = defaultdict(list)
    sequence = 0
    for lengths, n in plan_sequences(histogram, capacity):
        offset = 0
        for length in lengths:
            slots[length].append((n, sequence, offset))
            offset += length
        sequence += n
    # The slots of one length lie one after another; a piece's rank picks its slot.
    order = sorted(slots)
    first_slot = np.zeros(capacity + 2, dtype=np.int64)
    flat = [s for length in order for s in slots[length]]
    counts = np.array([s[0] for s in flat], dtype=np.int64)
    begins = np.cumsum(counts) - counts
    sequences = np.array([s[1] for s in flat], dtype=np.int64)
    offsets = np.array([s[2] for s in flat], dtype=np.int64)
    at = 0
    for length in order:
        first_slot[length] = begins[at]
        at += len(slots[length])

    buckets = total // _PIECES_PER_BUCKET + 1
    row_key = [F.col(n) for n in names if n in ("doc_id", "piece", "start", "length", "ids_crc32")]
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*row_key), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        keyed.groupBy("length", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    ranked = keyed.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*row_key)) - 1
    ).join(bases, ["length", "_bucket"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            place = first_slot[length] + batch.column("_rank").to_numpy()
            slot = np.searchsorted(begins, place, side="right") - 1
            columns = [batch.column(n) for n in names]
            columns += [pa.array(sequences[slot] + place - begins[slot]), pa.array(offsets[slot])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*names, (F.col("_rank") + F.col("_base")).cast("long").alias("_rank")).mapInArrow(
        assign, f"{schema}, sequence_id long, offset long"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces cut ``with_ids``: sequence_id, length, ids. A group
    holds at most one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
    )

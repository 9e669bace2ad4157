"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared without case and punctuation. Benchmark items are cut into windows of three eighths of
the item, of 36 to 128 bytes, one every quarter of a window: each half of an item of 88 bytes or more, and each
quote of 160 bytes, holds a whole window (items of up to 36 bytes are one window). A window has an edit budget
of 7 %, or less where that would leave under a quarter of it to be shared. If a document holds a
window within e edits, at least n + 1 - q(e + 1) of the window's n + 1 - q q-grams occur in the
document on diagonals that differ by at most e. Shared q-grams are counted in diagonal bands that
overlap by e, and only bands that meet the bound are aligned, within the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import free_name

Q = 12
LEAST, WINDOW = 36, 128  # bytes of a window
EDITS = 0.07
DIAGONALS = 16  # new diagonals of each band
BLOCK_BYTES = 256 << 10  # of items that a pass over the documents looks for
_BATCH = 4 << 20
_BITS = 22


def normalised(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space, trimmed, in UTF-8."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")).cast("binary")


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the q bytes at each place."""
    words = np.ndarray((max(len(data) - 7, 0),), "<u8", buffer=data, strides=(1,))
    n = max(len(data) - Q + 1, 0)
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15) + words[Q - 8 : Q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def window_places(n: int) -> tuple[int, list[int]]:
    """Size and starts of the windows of an item of ``n`` bytes."""
    size = min(n, WINDOW, max(LEAST, 3 * n // 8))
    return size, [*range(0, n - size, max(size // 4, 1)), n - size]


def edit_budget(size: int | np.ndarray, edits: float = EDITS) -> np.ndarray:
    """Edits at which a window of ``size`` bytes still shares a quarter of that many q-grams, if possible, and
    at most the share ``edits`` of its bytes."""
    kept = (size + 1 - size // 4) // Q - 1
    return np.maximum(np.minimum(np.floor(size * edits).astype(np.int64), kept), 0)


class Windows:
    """The windows of a block of items and an index of their q-grams."""

    def __init__(self, items: list[tuple[int | None, bytes]], edits: float = EDITS):
        self.item, self.shift, self.text = [], [], []
        for item_id, text in items:
            size, starts = window_places(len(text))
            for a in starts if size >= Q else []:
                self.item.append(item_id)
                self.shift.append(a)
                self.text.append(text[a : a + size])
        self.size = np.array([len(t) for t in self.text], dtype=np.int64)
        self.budget = edit_budget(self.size, edits)
        self.needed = self.size + 1 - Q * (self.budget + 1)
        grams = [_hashes(np.frombuffer(t, np.uint8)) for t in self.text]
        keys = np.concatenate([*grams, np.empty(0, np.uint64)])
        window = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        self.window, self.place = window[order], place[order]
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << _BITS, dtype=bool)
        self.maybe[self.keys >> np.uint64(64 - _BITS)] = True
        self.widest = int(self.budget.max(initial=0))
        self.longest = int(self.size.max(initial=0))

    def _bands(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents, windows and bands (first diagonal) that meet the bound."""
        sizes = np.array([len(t) + 1 for t in texts])
        begins = np.cumsum(sizes) - sizes
        h = _hashes(np.frombuffer(b"\n".join(texts), np.uint8))  # no q-gram of a window has a \n
        at = np.flatnonzero(self.maybe[h >> np.uint64(64 - _BITS)]) if len(self.keys) else np.empty(0, np.int64)
        k = np.minimum(np.searchsorted(self.keys, h[at]), max(len(self.keys) - 1, 0))
        known = self.keys[k] == h[at] if len(at) else np.empty(0, bool)
        at, k = at[known], k[known]
        n = self.count[k]
        hit = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = np.repeat(at, n)
        window = self.window[hit]
        doc = np.searchsorted(begins, at, side="right") - 1
        diagonal = at - begins[doc] - self.place[hit] + WINDOW  # 0 or more
        band = diagonal // DIAGONALS
        also = (diagonal % DIAGONALS < self.budget[window]) & (band > 0)
        doc, window = np.concatenate([doc, doc[also]]), np.concatenate([window, window[also]])
        band = np.concatenate([band, band[also] - 1])
        width = int(band.max(initial=0)) + 1
        found, counts = np.unique((doc * len(self.size) + window) * width + band, return_counts=True)
        window = found // width % len(self.size) if len(found) else found
        enough = counts >= self.needed[window]
        found = found[enough]
        return found // width // max(len(self.size), 1), window[enough], found % width * DIAGONALS - WINDOW

    def _distances(self, texts: list[bytes], doc, window, diagonal) -> tuple[np.ndarray, np.ndarray]:
        """Least edits to turn each window into a stretch of its document within the band, and where
        the best stretch ends."""
        width, rows = DIAGONALS + self.widest, self.longest
        pattern = np.full((len(doc), rows), -1, dtype=np.int16)
        region = np.full((len(doc), rows + width), -2, dtype=np.int16)
        for i, (d, w, a) in enumerate(zip(doc, window, diagonal)):
            p = self.text[w]
            pattern[i, : len(p)] = np.frombuffer(p, np.uint8)
            part = texts[d][max(a, 0) : max(a + region.shape[1], 0)]
            region[i, max(-a, 0) : max(-a, 0) + len(part)] = np.frombuffer(part, np.uint8)
        steps = np.arange(width)
        outside = diagonal[:, None] + steps < 0  # a stretch cannot begin before the document
        cost = np.where(outside, rows, 0).astype(np.int32)
        least, end = np.full(len(doc), rows), np.zeros(len(doc), dtype=np.int64)
        sizes = self.size[window]
        for r in range(1, rows + 1):
            change = cost + (region[:, r - 1 : r - 1 + width] != pattern[:, r - 1 : r])
            change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(change - steps, axis=1) + steps
            done = np.flatnonzero(sizes == r)
            if len(done):
                best = cost[done].argmin(axis=1)
                least[done] = cost[done, best]
                end[done] = diagonal[done] + best + r
        return least, end

    def matches(self, texts: list[bytes]) -> list[tuple]:
        """(document number, item, windows found, begin, end, edits) for documents that hold windows;
        places in bytes of the normalised text."""
        found: dict[tuple, list[int]] = {}
        doc, window, diagonal = self._bands(texts)
        for k in range(0, len(doc), 512):
            d, w, a = doc[k : k + 512], window[k : k + 512], diagonal[k : k + 512]
            least, end = self._distances(texts, d, w, a)
            for i in np.flatnonzero(least <= self.budget[w]).tolist():
                best = found.setdefault((int(d[i]), int(w[i])), [int(least[i]), int(end[i])])
                if least[i] < best[0]:
                    best[:] = int(least[i]), int(end[i])
        by_item: dict[tuple, list] = {}
        for (d, w), (edits, end) in sorted(found.items()):
            begin = max(0, end - len(self.text[w]))
            item = by_item.setdefault((d, self.item[w]), [0, begin, end, 0])
            item[:] = item[0] + 1, min(item[1], begin), max(item[2], end), max(item[3], edits)
        return [(d, item, *rest) for (d, item), rest in by_item.items()]


def _blocks(benchmark: DataFrame) -> Iterator[Windows]:
    """The items in blocks of bounded size, streamed through the driver."""
    items, size = [], 0
    for row in benchmark.select("item_id", normalised(F.col("text")).alias("t")).filter("t <> X''").toLocalIterator():
        if items and size + len(row.t) > BLOCK_BYTES:
            yield Windows(items)
            items, size = [], 0
        items.append((row.item_id, bytes(row.t)))
        size += len(row.t)
    yield Windows(items)


def _slices(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    begin, some, size = 0, [], 0
    for k, text in enumerate(texts):
        some.append(bytes(text or b""))
        size += len(some[-1])
        if size >= _BATCH:
            yield begin, some
            begin, some, size = k + 1, [], 0
    if some:
        yield begin, some


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item it holds a window of: doc_id, item_id, windows (found),
    begin and end (bytes of the normalised document), edits (most of a window).

    Null texts hold nothing; items of under 12 normalised bytes are too short to tell and match
    nothing; repeated documents or items give repeated rows, equal item_ids of a block are one item.
    Other columns are dropped. No benchmark: no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), normalised(F.col("text")).alias("t"))
    names = ["doc_id", "item_id", "windows", "begin", "end", "edits"]
    found = None
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)  # bounded by BLOCK_BYTES

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for begin, some in _slices(batch.column(1).to_pylist()):
                    rows = [(ids[begin + r[0]], *r[1:]) for r in shared.value.matches(some)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        part = texts.mapInArrow(search, ", ".join(f"{n} long" for n in names))
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of a benchmark item; columns and order of columns stay."""
    spark = docs.sparkSession
    names = docs.columns
    text = free_name(docs, "normalised")
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for begin, some in _slices(batch.column(batch.num_columns - 1).to_pylist()):
                    clean[[begin + r[0] for r in shared.value.matches(some)]] = False
                rest = pa.RecordBatch.from_arrays(batch.columns[:-1], names=names)
                yield rest.filter(pa.array(clean))

        docs = docs.select(*names, normalised(F.col("text")).alias(text)).mapInArrow(keep, docs.schema)
    return docs

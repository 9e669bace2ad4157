"""Periodic runs of words: stretches in which words one period apart are identical.

Short periods are scanned directly, one lag at a time. For periods q of w/2 < q <= w, w a power of two, the
hashes of all w-word grams are taken and, of each window of w/2 grams, the place of the least one. Inside
a run two windows q apart hold the same grams, so their minima are q apart as well and equal; and no gram
of w >= q words repeats inside one period. So neighbouring equal minima of a scale name every period of
it, and each such pair is extended word by word: hashes only propose, words decide.

Documents are laid one after another, with a word between them that equals no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIRECT = 8  # periods up to here are scanned lag by lag; a power of two
LEAST_WORDS = 6
LEAST_PERIODS = 4
_WORDS_AT_ONCE = 500_000
_TYPE = T.ArrayType(T.StructType([T.StructField(x, T.LongType(), False) for x in ("start", "length", "period")]), False)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _equal_ahead(ids: np.ndarray, at: int, lag: int) -> int:
    """Number of words from ``at`` on that equal those ``lag`` further."""
    found, size = 0, 32
    while True:
        b = ids[at + lag + found : at + lag + found + size]
        differ = np.flatnonzero(ids[at + found : at + found + len(b)] != b)
        if len(differ):
            return found + int(differ[0])
        found += len(b)
        if len(b) < size:
            return found
        size *= 2


def _equal_before(ids: np.ndarray, at: int, lag: int) -> int:
    """Number of words just before ``at`` that equal those ``lag`` further."""
    found, size = 0, 32
    while True:
        low = max(0, at - found - size)
        a, b = ids[low : at - found], ids[low + lag : at - found + lag]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return found + len(a) - 1 - int(differ[-1])
        found += len(a)
        if len(a) < size:
            return found
        size *= 2


def scanned(ids: np.ndarray, lag: int, least: int) -> Iterator[tuple[int, int, int]]:
    """start, length, period of the stretches of at least ``least`` words of one period."""
    apart = np.flatnonzero(ids[lag:] != ids[:-lag])
    bounds = np.concatenate([[-1], apart, [len(ids) - lag]])
    equal = np.diff(bounds) - 1
    hit = np.flatnonzero(equal >= least - lag)
    yield from ((int(bounds[k]) + 1, int(equal[k]) + lag, lag) for k in hit)


def seeds(hashes: np.ndarray, w: int) -> Iterator[tuple[int, int]]:
    """Place and lag, ascending by lag and place, of neighbouring equal minima w/2 < lag <= w apart.
    ``hashes`` are those of the w-word grams."""
    bits = np.uint64(max(1, len(hashes).bit_length()))
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while step < w // 2:  # windows of w/2 grams
        if len(least) <= step:
            return
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    places = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    places = places[np.concatenate([[True], places[1:] != places[:-1]])]
    keys = hashes[places]
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    first, lag = places[:-1], np.diff(places)
    same = (keys[1:] == keys[:-1]) & (lag > w // 2) & (lag <= w)
    first, lag = first[same], lag[same]
    order = np.lexsort([first, lag])
    yield from zip(first[order].tolist(), lag[order].tolist())


def runs_of(
    ids: np.ndarray, ends: list[int], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, direct: int = DIRECT
) -> np.ndarray:
    """Rows of start, length, period of all runs, by start, then period.

    ``ids`` has the words of documents from the longest to the shortest, a word of its own after each;
    ``ends`` the places of these. A run has its smallest period and as many words around it as keep it.
    Runs of fewer than four periods may hold no two equal windows, so ``least_periods`` is 4 or more.
    """
    if least_periods < 4 or direct & (direct - 1):
        raise ValueError("least_periods must be 4 or more, direct a power of two")
    lengths = np.diff([-1, *ends]) - 1

    def needed(period: int) -> int:
        return max(least_words, least_periods * period)

    def long_enough(words: int) -> int:
        """Where the documents of at least so many words end."""
        n = int(np.searchsorted(-lengths, -words, side="right"))
        return ends[n - 1] if n else 0

    found: list[tuple[int, int, int]] = []
    for lag in range(1, direct + 1):
        limit = long_enough(needed(lag))
        if limit > lag:
            found += scanned(ids[:limit], lag, needed(lag))
    hashes, k, w = _mixed(ids.astype(np.uint64) + np.uint64(1)), 1, 2 * direct
    while (limit := long_enough(needed(w // 2 + 1))) > w:
        hashes = hashes[: limit - k + 1]
        while k < w:
            hashes = _mixed(hashes[:-k] * np.uint64(0xD6E8FEB86659FD93) + hashes[k:])
            k *= 2
        covered, last = 0, 0
        for at, lag in seeds(hashes, w):
            if lag == last and at < covered:  # inside the stretch that an earlier seed grew to
                continue
            start = at - _equal_before(ids, at, lag)
            covered, last = at + _equal_ahead(ids, at, lag), lag
            if covered - start + lag >= needed(lag):
                found.append((start, covered - start + lag, lag))
        w *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.array(sorted(found), np.int64)
    # the same stretch at multiples of its period
    first = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    rows = rows[first]
    return rows[np.lexsort([rows[:, 2], rows[:, 0]])]


def find_runs(texts: list[list[bytes]], least_words: int, least_periods: int, direct: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each list of words: its runs, and the numbers of the words that no run holds after its first
    period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    known: dict[bytes, int] = {}
    parts, ends, size = [], [], 0
    for n, k in enumerate(order):
        parts.append(np.array([known.setdefault(w, len(known)) for w in texts[k]] + [-1 - n], np.int64))
        size += len(parts[-1])
        ends.append(size - 1)
    ids = np.concatenate(parts)
    rows = runs_of(ids, ends, least_words, least_periods, direct)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    cuts = np.searchsorted(rows[:, 0], [0, *ends])
    out: list = [None] * len(texts)
    begin = 0
    for n, k in enumerate(order):
        own = rows[cuts[n] : cuts[n + 1]] - [begin, 0, 0]
        out[k] = (own, np.flatnonzero(kept[begin : ends[n]]))
        begin = ends[n] + 1
    return out


def periodic_runs(
    docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, direct: int = DIRECT
) -> DataFrame:
    """``docs`` (with ``text``) and two columns: ``runs``, an array of (start, length, period) by start, then
    period, and ``collapsed``, the words that no run holds after its first period, joined by one space.

    Words are runs of characters other than ASCII white space, numbered from 0. A run is a stretch of at
    least ``least_words`` words and ``least_periods`` periods that cannot be extended; runs may overlap.
    Null and empty texts have no runs and an empty ``collapsed``. Columns of these two names are replaced.
    Documents stay where they are: nothing is shuffled; a task holds some half a million words, or the
    one longer text.
    """
    rest = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    source = docs.select(*[F.col(f"`{c}`") for c in rest])
    text = [c.lower() for c in rest].index("text")

    def finished(rows: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = find_runs(texts, least_words, least_periods, direct)
        kind = pa.list_(pa.struct([pa.field(x, pa.int64(), False) for x in ("start", "length", "period")]))
        runs = [[dict(zip(("start", "length", "period"), r)) for r in own.tolist()] for own, _ in found]
        left = [
            b" ".join(words if len(keep) == len(words) else [words[k] for k in keep.tolist()])
            for words, (_, keep) in zip(texts, found)
        ]
        added = [pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*rest, "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[list[bytes]] = []
            begin = size = 0
            for k, value in enumerate(batch.column(text).cast(pa.binary())):
                texts.append((value.as_py() or b"").split())
                size += len(texts[-1])
                if size >= _WORDS_AT_ONCE:
                    yield finished(batch.slice(begin, len(texts)), texts)
                    texts, begin, size = [], k + 1, 0
            if texts:
                yield finished(batch.slice(begin, len(texts)), texts)

    schema = T.StructType(list(source.schema.fields)).add("runs", _TYPE, False).add("collapsed", "string", False)
    return source.mapInArrow(run, schema)

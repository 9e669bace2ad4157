"""Removal of byte strings that repeat anywhere in a corpus, by suffix order and previous factors.

Every window of ``length`` bytes is filed under its anchor, the 64-byte string with the smallest hash
inside it, so that equal windows meet under one anchor. Neighbouring windows share anchors: a document
falls into segments of windows, some 170 windows each. Equal documents, then equal segments, are
reduced to one with its earliest place and its number, which settles all their windows. Where one
anchor still has several different segments, their texts are fetched and put in suffix order to the
depth of a window (by doubling); equal windows are neighbours there, ordered by place. The previous
smaller place of a window in that order is then its predecessor, and its longest previous factor reaches
the window's length exactly if the two are equal; the first of a run has none. Of an anchor with very
many different segments (a passage common to many documents) single windows are grouped by a 128-bit
hash instead, which needs no group in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import free_name
from tidemark.scratch import Scratch

FEW_SEGMENTS = 2_000  # different segments of an anchor that are put in suffix order together
FILTER_KEYS = 1 << 20  # 64-bit hashes that are broadcast to keep texts out of a shuffle, 16 MB
_CHUNK = 1 << 20
_ROWS = 20_000  # window rows of a batch
_BLOCK = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
NO_ID = -(1 << 63)


def _anchor_bytes(length: int) -> int:
    if length < 48:
        raise ValueError("windows need at least 48 bytes")
    return 1 << int(np.log2(length / 6))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two, at least 8) at every place."""
    h = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    width = 8
    while width < size:
        second = h[width:]
        h = (h[:-width] ^ (second >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + second
        width *= 2
    h ^= h >> np.uint64(32)
    return h * np.uint64(0x94D049BB133111EB)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    padded = padded.reshape(blocks, width)
    before = np.minimum.accumulate(padded, axis=1).reshape(-1)
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def segments(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of documents that lie one after another in ``data`` (at most 16 MB): document number,
    hash of the anchor, first and last window start (within ``data``)."""
    size = _anchor_bytes(length)
    none = np.empty(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none
    of = np.repeat(np.arange(len(sizes)), sizes)
    whole = of[: len(data) - length + 1] == of[length - 1 :]
    h = _gram_hashes(data, size)
    keys = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    place = (_sliding_least(keys, length - size + 1) & _PLACE).astype(np.int64)
    same = (place[1:] == place[:-1]) & whole[1:] & whole[:-1]
    first = np.flatnonzero(whole & ~np.concatenate([[False], same]))
    last = np.flatnonzero(whole & ~np.concatenate([same, [False]]))
    return of[first], h[place[first]].view(np.int64), first, last


def _scan(docs: DataFrame, length: int, form: Callable[[bytes | None], bytes]) -> DataFrame:
    """Per row: place key (doc_id), text key (SHA-256), size, and its segments as arrays, of the text's form."""
    kinds = {"anchor": pa.int64(), "same": pa.int64(), "first": pa.int32(), "last": pa.int32()}
    fields = [("at", pa.int64()), ("key", pa.binary()), ("size", pa.int64())]
    fields += [(name, pa.list_(kind)) for name, kind in kinds.items()]

    def block_rows(ids: list, texts: list[bytes], pieces: list[list[tuple]]) -> pa.RecordBatch:
        columns = [[] for _ in kinds]
        offsets = [0]
        for parts in pieces:
            for values in parts:
                for column, value in zip(columns, values):
                    column.append(value)
            offsets.append(offsets[-1] + sum(len(p[0]) for p in parts))
        lists = [
            pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(np.concatenate(c or [np.empty(0, np.int64)]), kind, safe=False)
            )
            for c, kind in zip(columns, kinds.values())
        ]
        known = [pa.array(ids, pa.int64()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(known + lists, schema=pa.schema(fields))

    def cut(data: bytes, sizes: list[int], shift: int = 0) -> list[list[tuple]]:
        """For each document of a block, its segments as arrays."""
        of, anchor, first, last = segments(np.frombuffer(data, np.uint8), np.array(sizes, np.int64), length)
        view = memoryview(data)
        same = np.frombuffer(
            b"".join([xxhash.xxh3_64_digest(view[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]), ">i8"
        ).astype(np.int64)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        cuts = np.searchsorted(of, np.arange(len(sizes) + 1))
        return [
            [(anchor[a:b], same[a:b], first[a:b] - begin[k] + shift, last[a:b] - begin[k] + shift)]
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
        ]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [form(t.as_py()) for t in batch.column(1)]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size + len(texts[end]) <= _BLOCK:
                    size += len(texts[end])
                    end += 1
                if end > at:
                    pieces = cut(b"".join(texts[at:end]), [len(t) for t in texts[at:end]])
                else:  # one text longer than a block: blocks that overlap by all but one byte of a window
                    text, end = texts[at], at + 1
                    parts = [text[b : b + _BLOCK + length - 1] for b in range(0, len(text), _BLOCK)]
                    pieces = [[x for k, p in enumerate(parts) for x in cut(p, [len(p)], k * _BLOCK)[0]]]
                yield block_rows(ids[at:end], texts[at:end], pieces)
                at = end

    out = "at long, key binary, size long, anchor array<long>, same array<long>, first array<int>, last array<int>"
    return docs.mapInArrow(scan, out)


def equal_windows(texts: list[bytes], owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the texts in suffix order to ``length`` bytes, equal ones ordered by place.

    ``owners`` gives the place of each text as sortable columns (k x n), its last row the place of its
    first byte. Returns for each window in that order: text number, start within the text, whether it
    equals its predecessor (its longest previous factor is at least ``length``), and its successor.
    """
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts) + bytes(length + 8), np.uint8)
    begins = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    of = np.repeat(np.arange(len(texts)), windows)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    rank = np.unique(np.ndarray((int(sizes.sum()),), ">u8", buffer=data, strides=(1,)), return_inverse=True)[1]
    depth = 8
    while depth < length:
        step = min(depth, length - depth)
        ahead = np.zeros_like(rank)
        ahead[:-step] = rank[step:]
        rank = np.unique(rank * (rank.max() + 1) + ahead, return_inverse=True)[1]
        depth += step
    rank = rank[begins[of] + inside]
    places = [row[of] for row in owners]
    places[-1] = places[-1] + inside
    order = np.lexsort([*places[::-1], rank])
    rank = rank[order]
    equal = rank[1:] == rank[:-1]
    return of[order], inside[order], np.concatenate([[False], equal]), np.concatenate([equal, [False]])


def _spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows at the given sorted starts."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(run[0]), int(run[-1]) + length) for run in np.split(starts, cuts)]


_SPAN_ROWS = "owner long, begin long, end long, later boolean"
_FETCHED = "anchor long, owner long, at long, first long, bytes binary"


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A shuffled join, split where a key is hot: both sides grow with the corpus."""
    return left.join(right.hint("merge"), on, how)


def _plain(text: bytes | None) -> bytes:
    return text or b""


def _once(texts: DataFrame, form: Callable[[bytes | None], bytes] = _plain) -> DataFrame:
    """at, key and the text's form; rows that repeat all of it within a task go only once, so that none is hot."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            shown = [form(t.as_py()) for t in batch.column(1)]
            keys = [hashlib.sha256(t).digest() for t in shown]
            new = []
            for pair in zip(batch.column(0).to_pylist(), keys):
                new.append(pair not in seen)
                seen.add(pair)
            some = pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(shown, pa.binary())], names=["at", "key", "text"])
            yield some.filter(pa.array(new, pa.bool_()))

    return texts.mapInArrow(once, "at long, key binary, text binary")


def _among(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``texts`` without those that ``wanted`` (at, key) lacks, so that they need not be shuffled, if
    the hashes of what is wanted are few enough to be sent to all tasks. Hashes may let one pass."""
    hashes = wanted.select(F.xxhash64("at", "key").alias("h")).distinct()
    if hashes.count() > FILTER_KEYS:
        return texts
    return texts.withColumn("h", F.xxhash64("at", "key")).join(F.broadcast(hashes), "h", "left_semi").drop("h")


def _fetch(
    texts: DataFrame, wanted: DataFrame, length: int, form: Callable[[bytes | None], bytes], then=None, schema: str = _FETCHED
) -> DataFrame:
    """Texts of wanted segments (owner, at, key, list of anchor, first, last), or what ``then`` makes of them: in
    one function, for a second one would keep as many Python workers again."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, owner, at, parts in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(p["anchor"], owner, at, p["first"], text[p["first"] : p["last"] + length]) for p in parts]
            for k in range(0, len(rows), 20_000):
                some = list(zip(*rows[k : k + 20_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(some, [pa.int64()] * 4 + [pa.binary()])],
                    names=["anchor", "owner", "at", "first", "bytes"])

    joined = _join(_among(_once(texts, form), wanted), wanted, ["at", "key"])
    run = (lambda batches: then(cut(batches))) if then else cut
    return joined.select("text", "owner", "at", "parts").mapInArrow(run, schema)


def _ordered_spans(fetched: DataFrame, length: int, later_only: bool) -> DataFrame:
    """Spans (owner, begin, end, later) from suffix order, whole anchors at a time: without ``later_only``
    those of all places, not marked, and those of later ones."""

    def spans(rows: list[tuple]) -> Iterator[tuple[int, int, int, bool]]:
        rows = list({(r[1], r[3]): r for r in rows}.values())
        owners = np.array([[r[2] for r in rows], [r[1] for r in rows], [r[3] for r in rows]], dtype=np.int64)
        of, inside, earlier, later = equal_windows([r[4] for r in rows], owners, length)
        for hit, marked in [(earlier, True)] + ([] if later_only else [(earlier | later, False)]):
            order = np.lexsort([inside[hit], of[hit]])
            texts, starts = of[hit][order], inside[hit][order]
            for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(texts)) + 1) if len(texts) else []:
                row = rows[texts[some[0]]]
                for begin, end in _spans_of(starts[some], length):
                    yield row[1], row[3] + begin, row[3] + end, marked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= _CHUNK and row[0] != held[-1][0]:
                    yield _span_rows(list(spans(held)))
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield _span_rows(list(spans(held)))

    by_anchor = fetched.repartition("anchor").sortWithinPartitions("anchor")
    return by_anchor.mapInArrow(run, _SPAN_ROWS)


_WINDOWS = "h1 long, h2 long, at long, owner long, first long, begin long"


def _windows_of(length: int, step: int):
    """Function that makes of batches of segments one row for each window, in small batches."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, owner, at, first, text = (c[row].as_py() for c in batch.columns)
                view = memoryview(text)
                all_places = range(-first % step, len(text) - length + 1, step)
                for k in range(0, len(all_places), _ROWS):
                    places = all_places[k : k + _ROWS]
                    n = len(places)
                    hashes = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[p : p + length]) for p in places]), "<i8")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[::2]), pa.array(hashes[1::2])]
                        + [pa.array(np.full(n, x)) for x in (at, owner, first)]
                        + [pa.array(np.arange(places.start, places.stop, step) + first)],
                        names=["h1", "h2", "at", "owner", "first", "begin"],
                    )

    return windows


def _window_spans(windows: DataFrame, length: int, later_only: bool, scratch: Scratch) -> DataFrame:
    """Spans (owner, begin, end, later) from single windows, grouped by a hash of their bytes."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (owner, *span, later)
                for owner, later, begins in zip(*(c.to_pylist() for c in batch.columns))
                for span in _spans_of(np.unique(begins), length)
            ]
            yield _span_rows(out)

    found = scratch.table(windows.distinct())
    place = F.struct("at", "owner", "begin")
    groups = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).filter("n > 1")
    hit = found.join(groups, ["h1", "h2"]).withColumn("later", place != F.col("least"))
    if later_only:
        hit = hit.filter("later")
    by_segment = hit.groupBy("owner", "first", "later").agg(F.collect_list("begin").alias("begins"))
    return by_segment.select("owner", "later", "begins").mapInArrow(runs, _SPAN_ROWS)


def _span_rows(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(list(zip(*found)) or [()] * 4, [pa.int64()] * 3 + [pa.bool_()])
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=["owner", "begin", "end", "later"])


def _merge(spans: list[dict]) -> list[dict]:
    """Maximal runs of a list of spans."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["begin"]):
        if out and s["begin"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append({"begin": s["begin"], "end": s["end"]})
    return out


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = batch.column("spans").to_pylist()
        spans = [_merge(x) for x in found]
        later = [_merge([s for s in x if s["later"]]) for x in found]
        n_later = [sum(s["end"] - s["begin"] for s in x) for x in later]
        later = [None if x == y else x for x, y in zip(later, spans)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("at"), batch.column("key"), batch.column("copies"), pa.array(spans, _SPANS), pa.array(later, _SPANS), pa.array(n_later, pa.int64())],
            names=["at", "key", "copies", "spans", "later", "n_later"])


def _texts(docs: DataFrame) -> DataFrame:
    """Place (doc_id, null first) and bytes of every row."""
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(at.alias("at"), F.col("text").cast("binary").alias("text"))


def repeated_spans(
    docs: DataFrame, length: int = 400, keep_first: bool = True, scratch: Scratch | None = None, step: int = 1,
    form: Callable[[bytes | None], bytes] = _plain,
) -> tuple[DataFrame, DataFrame]:
    """Bytes of ``docs`` (doc_id, text) covered by a string of ``length`` bytes that repeats. Where a string
    matters only at multiples of ``step`` bytes, others may be left out. ``form`` makes of a text the bytes
    that are looked at.

    Returns two tables. Different texts with something to remove: ``at`` (their smallest doc_id, null as
    NO_ID), ``key`` (SHA-256), ``copies``, ``spans`` (maximal runs of bytes, begin and end), ``later`` (those
    that go with ``keep_first``; null if they are the same), ``n_later`` (their bytes). And all
    rows: ``doc_id``, ``key``, ``size`` in bytes, ``copy``: the whole text goes because it equals another
    one (with ``keep_first``: one with a smaller doc_id, which ``later`` tells without it, too). ``keep_first`` leaves each string where it
    first starts, by doc_id (null first) and place; without it, all places go. Rows equal in doc_id and
    text count as one document with ``keep_first``, as copies without. Null text is empty; texts under
    ``length`` bytes have no repeats. Other columns are ignored.
    """
    _anchor_bytes(length)  # refuses windows that are too short
    scratch = scratch or Scratch(docs.sparkSession)
    texts = _texts(docs)
    rows = scratch.table(_scan(texts, length, form))
    lists = ["anchor", "same", "first", "last"]
    owners = scratch.table(
        rows.filter(F.col("size") >= length).groupBy("key")
        .agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("copies"), F.first(F.struct(*lists)).alias("lists"))
        .withColumn("owner", F.monotonically_increasing_id())
    )
    zipped = F.explode(F.arrays_zip(*[f"lists.{c}" for c in lists])).alias("p")
    parts = owners.select("owner", "at", zipped).select("owner", "at", "p.*")
    repeated = scratch.table(
        parts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    )
    live = scratch.table(_join(parts, repeated, ["anchor"]))
    place = F.struct("at", "owner", "first", "last")
    kinds = scratch.table(live.groupBy("anchor", "same").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")))
    # equal segments: all their windows repeat
    again = _join(live, kinds.filter("n > 1"), ["anchor", "same"]).withColumn("later", place != F.col("least"))
    if keep_first:
        again = again.filter("later")
    begin, end = F.col("first").cast("long").alias("begin"), (F.col("last") + length).cast("long").alias("end")
    spans = again.select("owner", begin, end, "later")
    # different segments of one anchor: some of their windows may be equal
    mixed = scratch.table(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"))
    most = mixed.agg(F.max("kinds")).first()[0] or 0
    compared = _join(kinds, mixed, ["anchor"]).select("anchor", "kinds", "least.*")

    def fetched(some: DataFrame, *made) -> DataFrame:
        listed = some.groupBy("owner").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("parts"))
        return _fetch(texts, scratch.table(_join(listed, owners.select("owner", "at", "key"), ["owner"])), length, form, *made)

    if most:
        few = fetched(compared.filter(F.col("kinds") <= FEW_SEGMENTS))
        spans = spans.union(_ordered_spans(few, length, keep_first))
    if most > FEW_SEGMENTS:
        many = fetched(compared.filter(F.col("kinds") > FEW_SEGMENTS), _windows_of(length, step), _WINDOWS)
        spans = spans.union(_window_spans(many, length, keep_first, scratch))
    by_owner = spans.groupBy("owner").agg(F.collect_set(F.struct("begin", "end", "later")).alias("spans"))
    found = scratch.table(
        _join(by_owner, owners.select("owner", "at", "key", "copies"), ["owner"])
        .select("at", "key", "copies", "spans")
        .mapInArrow(_merged, "at long, key binary, copies long, spans array<struct<begin:long,end:long>>, later array<struct<begin:long,end:long>>, n_later long")
    )
    copied = owners.filter("copies > 1").select("key", F.col("at").alias("first_at"))
    later = F.coalesce(F.col("at") != F.col("first_at"), F.lit(False))
    judged = _join(rows.select("at", "key", "size"), copied, ["key"], "left").select(
        F.when(F.col("at") != NO_ID, F.col("at")).alias("doc_id"), "key", "size",
        (later if keep_first else F.col("first_at").isNotNull()).alias("copy"), later.alias("later"))
    return found, judged


def cut_out(text: bytes, spans: list[dict], whole_characters: bool = False) -> bytes:
    """The text without the spans; with ``whole_characters`` a character that a span covers in part
    stays."""
    out, at = [], 0
    for s in spans:
        begin, end = s["begin"], s["end"]
        if whole_characters:
            while begin < end and text[begin] & 0xC0 == 0x80:
                begin += 1
            while end > begin and end < len(text) and text[end] & 0xC0 == 0x80:
                end -= 1
        out.append(text[at:begin])
        at = end
    return b"".join(out + [text[at:]])


_CLEANED = "at long, key binary, n_removed long, n_spans long, kept_sha256 string, left string, copies long, n_later long, once string"


def _cleaned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``at``, ``key``, spans and the bytes left of the texts in ``found``; ``once`` is what is left without
    their ``later`` spans, where there are any."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, later = (batch.column(c).to_pylist() for c in ("text", "spans", "later"))
            columns = [
                batch.column("at"),
                batch.column("key"),
                pa.array([sum(s["end"] - s["begin"] for s in x) for x in spans], pa.int64()),
                pa.array([len(x) for x in spans], pa.int64()),
                pa.array([hashlib.sha256(cut_out(t, x)).hexdigest() for t, x in zip(texts, spans)], pa.string()),
                pa.array([cut_out(t, x, True).decode() for t, x in zip(texts, spans)], pa.string()),
                batch.column("copies"),
                batch.column("n_later"),
                pa.array([cut_out(t, x, True).decode() if x else None for t, x in zip(texts, later)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _CLEANED.split(", ")])

    joined = _join(_among(_once(_texts(docs)), found), found, ["at", "key"])
    return joined.select("at", "key", "text", "spans", "later", "copies", "n_later").mapInArrow(clean, _CLEANED)


def digests(docs: DataFrame, length: int = 400, keep_first: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes left), ``text``,
    what is left in whole characters, and without ``keep_first`` also ``n_later``, the bytes that would go
    with it (of strings that also start earlier), and ``deduplicated``, the text that would be left then;
    other cases as in ``repeated_spans``."""
    scratch = scratch or Scratch(docs.sparkSession)
    found, judged = repeated_spans(docs, length, keep_first, scratch)
    nothing = hashlib.sha256(b"").hexdigest()
    removed = ["n_removed", "n_spans", "kept_sha256", "left"]
    copies = judged.filter("copy").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), "key", F.col("size").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(nothing).alias("kept_sha256"), F.lit("").alias("left"), F.when(F.col("later"), F.col("size")).alias("n_later"),
        F.lit(None).cast("string").alias("once"))
    needed = found
    if not keep_first:  # all of a text with copies goes, of its first one only what starts earlier if the first stays
        copied = F.col("copies") > 1
        needed = found.filter(~copied | (F.col("n_later") > 0)).withColumn("later", F.when(copied, F.coalesce("later", "spans")).otherwise(F.col("later")))
    cleaned = _cleaned(docs, needed)
    if not keep_first:
        cleaned = cleaned.withColumns({c: F.when(F.col("copies") == 1, F.col(c)) for c in removed})
    changes = cleaned.drop("copies").union(copies).groupBy("at", "key").agg(*[F.max(c).alias(c) for c in [*removed, "n_later", "once"]])
    changes = scratch.table(changes)
    content = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("at"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("key"), content.alias("text"))
    zero = F.lit(0).cast("long")
    n_later = F.coalesce("n_later", zero)
    once = F.when(n_later == 0, F.col("text")).when(n_later == F.col("n_removed"), F.col("left")).otherwise(F.col("once"))
    return _join(texts, changes, ["at", "key"], "left").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("key"))).alias("kept_sha256"),
        F.coalesce("left", "text").alias("text"),
        *([] if keep_first else [n_later.alias("n_later"), once.alias("deduplicated")]),
    )


def _replaced(docs: DataFrame, changes: DataFrame, least_left: int) -> DataFrame:
    """``docs`` with the texts of ``changes`` (at, SHA-256 of the text, what is left of it)."""
    at, key, rest = (free_name(docs, n) for n in ("at", "key", "left"))
    changed = changes.toDF(at, key, rest)
    places = {at: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
              key: F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))}
    joined = _join(docs.withColumns(places), changed, [at, key], "left")
    changes = F.col(rest).isNotNull()
    kept = joined.filter(~changes | (F.octet_length(rest) >= least_left))
    out = {"text": F.coalesce(rest, "text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changes, F.length(rest)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[out[c].alias(c) if c in out else c for c in docs.columns])


def remove_repeats(docs: DataFrame, length: int = 400, least_left: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with later copies of repeated strings cut out of ``text``, the first one kept; rows of
    which fewer than ``least_left`` bytes are left through that go. A character that a string covers in
    part stays. Columns are those of ``docs``; ``n_chars`` follows the text where there is one."""
    scratch = scratch or Scratch(docs.sparkSession)
    found, judged = repeated_spans(docs, length, True, scratch)
    left = _cleaned(docs, found).select("at", "key", "left").dropDuplicates(["at", "key"])
    gone = judged.filter("copy").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), "key", F.lit("").alias("left")).distinct()
    return _replaced(docs, scratch.table(left.union(gone)), least_left)


CODE = 4  # bytes of a word's code


def _codes(text: bytes | None) -> bytes:
    """The words of a text (split at ASCII white space) as hashes of four bytes each."""
    digest = xxhash.xxh32_intdigest
    return np.array([digest(w) for w in (text or b"").split()], dtype="<u4").tobytes()


_WORD = re.compile(rb"\S+")


def cut_words(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans (in bytes of codes; words covered in part stay) and the
    white space after them."""
    words = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for s in spans:
        first, last = -(-s["begin"] // CODE), s["end"] // CODE
        if first < last:
            out.append(text[at : words[first][0]])
            at = words[last][0] if last < len(words) else words[last - 1][1]
    out = b"".join(out + [text[at:]])
    return out if out.split() else b""


def remove_repeated_words(docs: DataFrame, words: int = 51, least_left: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """As ``remove_repeats``, for runs of ``words`` words that repeat, however long their words are and
    whatever white space is between them."""
    scratch = scratch or Scratch(docs.sparkSession)
    length = words * CODE
    found, judged = repeated_spans(docs, length, True, scratch, CODE, _codes)
    gone = judged.filter("copy").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), "key")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.lit(-1).cast("long").alias("end")))
    changed = scratch.table(
        found.select("at", "key", "spans").union(gone.withColumn("spans", everything)).dropDuplicates(["at", "key"])
    )

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [hashlib.sha256(_codes(t)).digest() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), batch.column(1)], names=["at", "key", "text"])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            left = ["" if x[0]["end"] < 0 else cut_words(t, x).decode() for t, x in zip(texts, spans)]
            keys = [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(keys, pa.binary()), pa.array(left, pa.string())], names=["at", "key", "left"])

    texts = _among(_texts(docs).mapInArrow(keyed, "at long, key binary, text binary"), changed)
    left = _join(texts, changed, ["at", "key"]).select("at", "text", "spans").mapInArrow(clean, "at long, key binary, left string")
    return _replaced(docs, scratch.table(left.dropDuplicates(["at", "key"])), least_left)

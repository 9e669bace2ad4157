"""Language-model scores by masked pseudo-likelihood.

A small network predicts every word of a text from the two words on either side; the sum of the log
probabilities of all words given their neighbours scores the text. Words are hashed to buckets, of which the
corpus's most frequent have an id of their own and the rest share some. An id is predicted
as three digits: the first (a class of ids of similar frequency) from the neighbours, the others from the
neighbours and the digits before. Documents are scored by words: the share of a word in
the count of its id is added to the probability of the id.

Counts come from all words, and every word of every document is a training target. The number of ids (and
with it of buckets, classes and parameters) grows with the square root of the words of the corpus, up to
what a task can hold. Each partition trains from the same start, and the average of the results, weighted by
targets, is the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.line_rules import words_of
from tidemark.scratch import Scratch

LEAST, MOST = 8, 22  # values of a later digit: 4,096 ids at least, 234,256 (60 MB of embeddings) at most
BUCKETS_PER_ID = 16
SHARED = 16  # one of so many ids is shared by infrequent buckets
OFFSETS = (-2, -1, 1, 2)
WIDTH = 16
_CELLS = 1 << 17  # values of digits that are worked on at once: 512 KB, which stay in a core's cache
_SLOT_BITS = 20
FREQUENT = 1 << 18  # words at most whose counts are sent to all tasks


def values_of_digit(words: int) -> int:
    """Values of the second and third digit, for a corpus of ``words``; the first has their square, so that
    ids are about the square root of the words."""
    return min(max(math.ceil(words**0.125), LEAST), MOST)


def ids_by_frequency(counts: np.ndarray, n_ids: int) -> np.ndarray:
    """Id of each bucket: its rank for the most frequent (ties by bucket), a shared one for the rest."""
    shared = n_ids // SHARED
    own = n_ids - shared
    ids = (own + np.arange(len(counts)) % shared).astype(np.int64)
    best = np.lexsort([np.arange(len(counts)), -counts])[:own]
    ids[best] = np.arange(len(best))
    return ids


@dataclass
class WindowNetwork:
    """Parameters; ``ids`` maps buckets to ids. The id beyond either end of a text comes after all others."""

    ids: np.ndarray
    embeddings: np.ndarray  # offset, id, width
    weights: np.ndarray  # width, values of all three digits
    first: np.ndarray  # biases of the first digit
    second: np.ndarray  # first digit, second digit
    third: np.ndarray  # first two digits, third digit

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 7) -> WindowNetwork:
        """Random embeddings, and biases that give each id its share in the corpus; ``counts`` by bucket."""
        n_ids = len(counts) // BUCKETS_PER_ID
        w = round(n_ids**0.25)
        ids = ids_by_frequency(counts, n_ids)
        rng = np.random.default_rng(seed)
        share = np.bincount(ids, weights=counts, minlength=n_ids).reshape(w * w, w, w) + 0.5
        pairs = share.sum(axis=2)
        classes = pairs.sum(axis=1)
        return cls(
            ids,
            rng.normal(0, 0.1, (len(OFFSETS), n_ids + 1, WIDTH)).astype(np.float32),
            rng.normal(0, 0.1, (WIDTH, w * w + 2 * w)).astype(np.float32),
            np.log(classes / classes.sum()).astype(np.float32),
            np.log(pairs / classes[:, None]).astype(np.float32),
            np.log(share / pairs[:, :, None]).reshape(-1, w).astype(np.float32),
        )

    @property
    def nothing(self) -> int:
        return self.embeddings.shape[1] - 1

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)[1:]]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def with_flat(self, values: np.ndarray) -> WindowNetwork:
        sizes = [p.size for p in self.parameters()]
        parts = np.split(values.astype(np.float32), np.cumsum(sizes)[:-1])
        return WindowNetwork(self.ids, *(v.reshape(p.shape) for v, p in zip(parts, self.parameters())))

    def ids_of(self, words: np.ndarray) -> np.ndarray:
        return self.ids[words % len(self.ids)]

    def _digits(self, targets: np.ndarray) -> np.ndarray:
        """The value of each digit (digit, target), counted from the first value of the first digit."""
        w = self.second.shape[1]
        pairs = targets // w
        first = targets // (w * w)
        return np.stack([first, pairs - first * w + len(self.first), targets - pairs * w + len(self.first) + w])

    def _parts(self) -> list[slice]:
        """Where each digit's values are."""
        ends = np.cumsum([0, len(self.first), self.second.shape[1], self.third.shape[1]])
        return [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]

    def _blocks(self, n: int) -> list[slice]:
        """Blocks of ``n`` targets whose values of digits are few enough to stay in the cache."""
        size = max(_CELLS // self.weights.shape[1], 64)
        return [slice(at, min(at + size, n)) for at in range(0, n, size)]

    def _places(self, context: np.ndarray) -> np.ndarray:
        """Rows of the contexts (offset, target) in the embeddings of all offsets, which lie one after another."""
        return context + (np.arange(len(context)) * (self.nothing + 1))[:, None]

    def _output(self) -> np.ndarray:
        """Weights and, as those of a hidden value that is always one, the biases of the first digit."""
        biases = np.concatenate([self.first, np.zeros(self.weights.shape[1] - len(self.first), self.first.dtype)])
        return np.vstack([self.weights, biases]).T.copy()

    def _farthest(self) -> float:
        """No unnormalised log probability is farther from zero, for hidden values lie between -1 and 1."""
        biases = max(max(b.max(), -b.min()) for b in (self.first, self.second, self.third))
        return np.abs(self.weights).sum(axis=0).max() + biases

    def _forward(self, targets: np.ndarray, places: np.ndarray, output: np.ndarray, far: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and a one (target, width + 1) and unnormalised log probabilities (value of a digit,
        target), whose exponentials stay in the range of floats; ``far``: they may have to be shifted."""
        around = self.embeddings.reshape(-1, self.embeddings.shape[-1])
        total = around.take(places[0], axis=0)
        for some in places[1:]:
            total += around.take(some, axis=0)
        h = np.ones((len(targets), output.shape[1]), output.dtype)
        np.tanh(total, out=h[:, :-1])
        x = output @ h.T
        _, two, three = parts = self._parts()
        w = len(self.third[0])
        pairs = targets // w
        x[two] += self.second.take(pairs // w, axis=0).T
        x[three] += self.third.take(pairs, axis=0).T
        if far:
            _shift(x, parts)
        return h, x

    def log_probabilities(self, targets: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Log probability of each target id given its context (offset, target)."""
        out = np.empty(len(targets), self.weights.dtype)
        places, digits, parts, output, far = self._places(context), self._digits(targets), self._parts(), self._output(), self._farthest() > 60
        for block in self._blocks(len(targets)):
            some = targets[block]
            _, x = self._forward(some, places[:, block], output, far)
            found = x.ravel().take(digits[:, block] * len(some) + np.arange(len(some))).sum(axis=0)
            np.exp(x, out=x)
            for part in parts:
                found -= np.log(_sums(x[part]))
            out[block] = found
        return out

    def touched_gradients(self, targets: np.ndarray, context: np.ndarray) -> list[tuple]:
        """Of the mean negative log probability, in the order of ``parameters``: rows (of the parameter as
        a table; None for all of it) and their gradients. Those of other rows are zero."""
        n, w, dtype = len(targets), self.second.shape[1], self.weights.dtype
        places, digits, parts, output, far = self._places(context), self._digits(targets), self._parts(), self._output(), self._farthest() > 60
        one, two, three = parts
        each = dtype.type(1 / n)
        d_sum, d_second, d_third = (np.empty((n, k), dtype) for k in (self.weights.shape[0], w, w))
        d_output = np.zeros_like(output)
        for block in self._blocks(n):
            some = targets[block]
            h, d = self._forward(some, places[:, block], output, far)
            np.exp(d, out=d)
            for part in parts:
                p = d[part]
                p *= each / _sums(p)
            at, flat = digits[:, block] * len(some) + np.arange(len(some)), d.ravel()
            flat[at] = flat.take(at) - each
            d_output += d @ h
            d_second[block], d_third[block] = d[two].T, d[three].T
            into = np.matmul(d.T, self.weights.T, out=d_sum[block])
            h *= h
            into *= np.subtract(1, h, out=h)[:, :-1]
        pairs = targets // w
        return [
            _row_sums(places.ravel(), d_sum), (None, d_output[:, :-1].T), (None, d_output[one, -1]),
            _row_sums(pairs // w, d_second), _row_sums(pairs, d_third),
        ]

    def gradients(self, targets: np.ndarray, context: np.ndarray) -> list[np.ndarray]:
        """As ``touched_gradients``, of all rows."""
        out = []
        for p, (at, g) in zip(self.parameters(), self.touched_gradients(targets, context)):
            if at is not None:
                whole = np.zeros_like(p)
                whole.reshape(-1, p.shape[-1])[at] = g
                g = whole
            out.append(g)
        return out

    def text_scores(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum of the log probabilities of the ids of each text; texts lie one after another."""
        around = contexts(ids, sizes, self.nothing)
        return _text_sums(self.log_probabilities(ids, around), sizes)


def _shift(x: np.ndarray, parts: list[slice]) -> None:
    """Subtract from the values of each digit their maximum, if exponentials could leave the range of floats."""
    if x.size and (x.max() > 60 or x.min() < -60):
        for part in parts:
            x[part] -= x[part].max(axis=0)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.ones(len(x), x.dtype) @ x


def _text_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=values, minlength=len(sizes)).astype(float)


def _row_sums(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different places, and for each the sum of its rows of ``values``, which are used again from the first
    where there are more places than rows. Two numbers are added at a time where rows allow, as one complex."""
    seen = np.zeros(at.max() + 1 if len(at) else 0, bool)
    seen[at] = True
    places = np.flatnonzero(seen)
    number = np.empty(len(seen), np.int64)
    number[places] = np.arange(len(places))
    out = np.zeros((len(places), values.shape[1]), values.dtype)
    pairs = np.dtype(f"c{2 * values.itemsize}") if values.shape[1] % 2 == 0 else values.dtype
    into, items = out.view(pairs), np.ascontiguousarray(values).view(pairs)
    width = into.shape[1]
    for first in range(0, len(at), max(len(values), 1)):
        some = number.take(at[first : first + len(values)]) * width
        np.add.at(into.reshape(-1), np.add.outer(some, np.arange(width)).ravel(), items[: len(some)].reshape(-1))
    return places, out


def _put_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``table[at] = rows``, each row as one item, which takes a third of the time."""
    item = f"V{table.shape[1] * table.itemsize}"
    np.put(table.view(item), at, np.ascontiguousarray(rows).view(item))


def contexts(ids: np.ndarray, sizes: np.ndarray, nothing: int) -> np.ndarray:
    """Ids around each word (offset, word) of texts that lie one after another; ``nothing`` beyond their ends."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    out = np.full((len(OFFSETS), len(ids)), nothing, dtype=np.int64)
    for k, offset in enumerate(OFFSETS):
        n = len(ids) - abs(offset)
        if n > 0:
            here, there = (slice(-offset, None), slice(0, n)) if offset < 0 else (slice(0, n), slice(offset, None))
            out[k, here] = np.where(of[here] == of[there], ids[there], nothing)
    return out


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column and the size of each list."""
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def word_hashes(docs: DataFrame) -> DataFrame:
    """A number for each row, its doc_id and the 64-bit hashes of its words (lower-cased, split at ASCII white
    space)."""
    words = words_of(F.lower(F.coalesce("text", F.lit(""))))
    hashes = F.transform(words, lambda w: F.xxhash64(w)).alias("words")
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), hashes)


def count_words(hashes: DataFrame) -> DataFrame:
    """word (hash) and its count ``n`` over all rows."""
    return hashes.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_buckets(counts: DataFrame) -> np.ndarray:
    """Words per bucket in the whole corpus; one row a bucket, of 3.7 million at most, reaches the driver."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = np.zeros(BUCKETS_PER_ID * values_of_digit(total) ** 4, dtype=np.int64)
    by_bucket = counts.groupBy(F.pmod("word", F.lit(len(out))).alias("bucket")).agg(F.sum("n").alias("n")).toPandas()
    out[by_bucket["bucket"].to_numpy(np.int64)] = by_bucket["n"].to_numpy()
    return out


def train(network: WindowNetwork, ids: np.ndarray, sizes: np.ndarray, state: list[np.ndarray], every: int, rate: float, size: int, seed: int) -> int:
    """One pass over every ``every``-th word of the texts, in place; returns the number of targets."""
    around = np.ascontiguousarray(contexts(ids, sizes, network.nothing).T)  # those of a word side by side
    begins = np.cumsum(sizes) - sizes
    inside = np.arange(len(ids)) - np.repeat(begins, sizes)
    chosen = np.flatnonzero((inside + np.repeat(sizes, sizes)) % every == 0)
    np.random.default_rng(seed).shuffle(chosen)
    for at in range(0, len(chosen), size):
        some = chosen[at : at + size]
        for p, (at_rows, g), s in zip(network.parameters(), network.touched_gradients(ids[some], around.take(some, axis=0).T), state):
            if at_rows is None:
                s += g * g
                p -= rate * g / np.sqrt(s)
                continue
            p, s = (x.reshape(-1, x.shape[-1]) for x in (p, s))  # views
            so_far = s.take(at_rows, axis=0)
            so_far += g * g
            _put_rows(s, at_rows, so_far)
            g /= np.sqrt(so_far, out=so_far)
            g *= rate
            _put_rows(p, at_rows, p.take(at_rows, axis=0) - g)
    return len(chosen)


def fit(hashes: DataFrame, counts: np.ndarray, every: int = 1, rate: float = 0.1, batch: int = 4_096, seed: int = 7) -> WindowNetwork:
    """Train on all rows of ``hashes`` (from ``word_hashes``), with ``counts`` by bucket; without words, the
    start. A partition returns how far each group of parameters that it changed has moved."""
    begin = WindowNetwork.start(counts, seed)
    sent = hashes.sparkSession.sparkContext.broadcast(begin)  # bounded by MOST
    columns = [f"v{k}" for k in range(WIDTH)]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = sent.value
        network = start.with_flat(start.flat())
        state = [np.full_like(p, 1e-6) for p in network.parameters()]
        targets, held, sizes = 0, [], []

        def flush() -> int:
            if not held:
                return 0
            return train(network, network.ids_of(np.concatenate(held)), np.concatenate(sizes), state, every, rate, batch, seed + targets)

        for some in batches:
            values, n = _lists(some.column(0))
            held.append(values)
            sizes.append(n)
            if sum(map(len, held)) > 1 << 20:
                targets += flush()
                held, sizes = [], []
        targets += flush()
        if targets:
            moved = _groups(network.flat() - start.flat())
            changed = np.flatnonzero(moved.any(axis=1))
            for some in (np.array([-1]), *np.array_split(changed, len(changed) // 10_000 + 1)):  # -1: the targets
                arrays = [pa.array(some), pa.array(np.full(len(some), targets)), *(pa.array(v) for v in moved[some].T)]
                yield pa.RecordBatch.from_arrays(arrays, names=["place", "weight", *columns])

    trained = hashes.select("words").mapInArrow(local, "place long, weight long, " + ", ".join(f"{c} float" for c in columns))
    sums = [F.sum(F.col(c).cast("double") * F.col("weight")).alias(c) for c in columns]
    found = trained.groupBy("place").agg(F.sum("weight").alias("weight"), *sums).toPandas()
    flat = begin.flat()
    moved = _groups(np.zeros(len(flat)))
    rows = found[found["place"] >= 0]
    if len(rows):
        moved[rows["place"].to_numpy()] = rows[columns].to_numpy() / int(found.loc[found["place"] < 0, "weight"].iloc[0])
    sent.destroy()
    return begin.with_flat(flat + moved.ravel()[: len(flat)])


def _groups(values: np.ndarray) -> np.ndarray:
    """``values`` in rows of WIDTH, the last one filled up with zeros."""
    return np.concatenate([values, np.zeros(-len(values) % WIDTH, values.dtype)]).reshape(-1, WIDTH)


def frequent_words(counts: DataFrame) -> DataFrame:
    """The rows of ``counts`` above a count, at most FREQUENT, and as many as eight counts in an octave allow."""
    step = F.floor(F.log2("n") * 8)
    cut, total = 1 << 10, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # 8 * 63 rows at most
        total += row["count"]
        if total > FREQUENT:
            break
        cut = row["step"]
    return counts.filter(step >= cut)


def _slots(words: np.ndarray) -> np.ndarray:
    return (words >> (64 - _SLOT_BITS)) + (1 << _SLOT_BITS - 1)


def slot_starts(known: np.ndarray) -> np.ndarray:
    """Where the words of each slot (the high bits of a hash) begin among the sorted hashes ``known``."""
    return np.concatenate([[0], np.cumsum(np.bincount(_slots(known), minlength=1 << _SLOT_BITS))]).astype(np.int32)


def find_words(words: np.ndarray, known: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Place of each word in ``known``, -1 if it is not there. Only words of slots with several others are searched for."""
    if not len(known):
        return np.full(len(words), -1)
    slots = _slots(words)
    first = starts.take(slots)
    place = np.where(known.take(first, mode="clip") == words, first, -1)
    rest = np.flatnonzero((place < 0) & (starts.take(slots + 1) - first > 1))
    found = np.searchsorted(known, words[rest])
    place[rest] = np.where(known.take(found, mode="clip") == words[rest], found, -1)
    return place


def score_words(hashes: DataFrame, counts: DataFrame, network: WindowNetwork, of_bucket: np.ndarray, scratch: Scratch) -> DataFrame:
    """row, doc_id, n_words and log_prob: the sum over the words of a row of their log probabilities, which are
    those of their ids and log(count of the word / count of all words of its id).

    Counts of words are a Spark table. The most frequent are sent to all tasks, so that no word is a hot key;
    the others are joined.
    """
    log_ids = np.log(np.maximum(np.bincount(network.ids, weights=of_bucket, minlength=network.nothing), 1))
    top = frequent_words(counts).toPandas().sort_values("word")
    sent = hashes.sparkSession.sparkContext.broadcast(
        (network, log_ids, top["word"].to_numpy(np.int64), np.log(top["n"].to_numpy(float)))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, total, frequent, logs = sent.value
        starts = slot_starts(frequent)
        for batch in batches:
            words, sizes = _lists(batch.column(2))
            ids = net.ids_of(words)
            part = -total[ids]
            place = find_words(words, frequent, starts)
            found = place >= 0
            part[found] += logs[place[found]]
            ends = np.concatenate([[0], np.cumsum(_text_sums(~found, sizes))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(net.text_scores(ids, sizes) + _text_sums(part, sizes)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(words[~found], pa.int64()))],
                names=["row", "doc_id", "n_words", "part", "rare"])

    table = scratch.table(hashes.mapInArrow(run, "row long, doc_id long, n_words long, part double, rare array<long>"))
    rare = table.select("row", F.explode("rare").alias("word")).join(counts, "word")
    none = F.lit(None).cast("long")
    parts = table.drop("rare").union(rare.select("row", none, none, F.log("n")))
    return parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("part").alias("log_prob"))


def score_documents(docs: DataFrame, scratch: Scratch | None = None, **options) -> DataFrame:
    """Train on ``docs`` (doc_id, text) and score every row by the probabilities of its words. Null text has
    no words: log_prob 0. Repeated rows each train and score; other columns are dropped."""
    scratch = scratch or Scratch(docs.sparkSession)
    hashes = scratch.table(word_hashes(docs))
    counts = scratch.table(count_words(hashes))
    of_bucket = count_buckets(counts)
    network = fit(hashes, of_bucket, **options)
    scored = score_words(hashes, counts, network, of_bucket, scratch)
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return scored.select("doc_id", "n_words", "log_prob", mean.alias("mean_log_prob"))

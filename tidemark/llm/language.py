"""Language identification by interpolated Kneser-Ney character models, one for each language.

A model's highest order counts occurrences of character 5-grams, its lower orders in how many different
characters' company a shorter gram stands; every order gives a discount to the next lower one, the lowest
to an even spread over all characters. All probabilities a text can ask for are worked out beforehand
and kept in hash arrays, sorted for binary search, with one column per language: of grams, and of the
weights that contexts leave to lower orders. A text gets the language of the least cross-entropy per
character. Held-back pieces of many lengths fit how sure that is, and from where on it is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.scratch import Scratch

ORDER = 5
UNDETERMINED = "und"
MAX_CHARS = 400_000  # characters of whole sample texts per language
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32
MAX_LANGUAGES = 100
MAX_CELLS = 100_000_000  # sample characters of a language, times the square of the number of languages
_CELLS_AT_ONCE = 1_000_000  # numbers in one array while texts are scored
_PIECES = (20, 60, 200, 1_000, 10_000)  # lengths of the pieces that calibrate
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def normal_codes(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, each stretch of what is not a letter made one space, none at
    the start; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return codes[:0]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    return np.where(letter, codes, np.uint32(_SPACE))[kept]


def _powers() -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(ORDER - 1, _BASE, np.uint64)]))


def hashes_of(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the grams of 1 to ORDER characters that end at each place from ORDER - 1 on."""
    wide = codes.astype(np.uint64) + np.uint64(1)
    total = np.zeros(max(0, len(codes) - ORDER + 1), np.uint64)
    for back, power in enumerate(_powers()):
        total = total + wide[ORDER - 1 - back : len(wide) - back] * power
        yield total


def _gram_hashes(grams: np.ndarray) -> np.ndarray:
    """Hashes of grams given as rows of code points."""
    n = grams.shape[1]
    return ((grams.astype(np.uint64) + np.uint64(1)) * _powers()[:n][::-1]).sum(axis=1, dtype=np.uint64)


def _unique(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different rows, sorted; the rows; the number of each; and for each row given which it is."""
    hashes, first, place, number = np.unique(_gram_hashes(grams), return_index=True, return_inverse=True, return_counts=True)
    return hashes, grams[first], number, place


@dataclass
class _Order:
    """One order of one language: discounted shares of grams, and what contexts leave to lower orders. The
    hashes are sorted."""

    grams: np.ndarray
    hashes: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    left: np.ndarray


def _order(grams: np.ndarray, counts: np.ndarray) -> _Order:
    """``grams`` in the order of their hashes."""
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    discount = once / (once + 2 * twice) if once and twice else 0.5
    if grams.shape[1] > 1:
        contexts, _, kinds, place = _unique(grams[:, :-1])
    else:
        contexts, kinds, place = np.zeros(1, np.uint64), np.array([len(grams)]), np.zeros(len(grams), np.int64)
    totals = np.bincount(place, weights=counts)
    return _Order(grams, _gram_hashes(grams), (counts - discount) / totals[place], contexts, discount * kinds / totals)


def _orders(grams: np.ndarray, counts: np.ndarray) -> list[_Order]:
    """Orders 1 to ORDER of a language from the counts of its highest."""
    order = np.argsort(_gram_hashes(grams))
    grams, counts = grams[order], counts[order]
    found = [_order(grams, counts)]
    while grams.shape[1] > 1:
        # each different longer gram is one company, to the left, of the shorter one
        _, grams, counts, _ = _unique(grams[:, 1:])
        found.append(_order(grams, counts))
    return found[::-1]


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


@dataclass
class LanguageModel:
    """Log-probabilities in sorted hash arrays, rows of one number per language.

    ``grams[n]`` and ``contexts[n]`` are (hashes, rows) of order n + 1; a gram that no language has seen
    at an order takes its context's row there plus what the next lower order says. Confidence is
    ``sigmoid(slope * margin * sqrt(characters) + offset)``; a prediction is rejected below ``accept``, or
    when no language is nearer than its ``limit`` to a text of 50 characters or more."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    lowest: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    accept: float = 0.0
    limits: np.ndarray | None = None

    def _logs(self, codes: np.ndarray) -> np.ndarray:
        """Log-probabilities of the characters from place ORDER - 1 on, a row of languages each."""
        hashes = list(hashes_of(codes))
        before = list(hashes_of(np.concatenate([[np.uint32(0)], codes[:-1]])))  # contexts end one earlier
        out = np.zeros((len(hashes[0]), len(self.languages)), np.float32)
        open_at = np.arange(len(out))
        for n in range(ORDER - 1, -1, -1):
            keys, rows = self.grams[n]
            wanted = hashes[n][open_at]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            out[open_at[hit]] += rows[at[hit]]
            open_at = open_at[~hit]
            if not len(open_at):
                return out
            keys, rows = self.contexts[n]
            wanted = before[n - 1][open_at] if n else np.zeros(len(open_at), np.uint64)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            out[open_at[hit]] += rows[at[hit]]
        out[open_at] += self.lowest
        return out

    def entropies(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (nats) of normalised texts under each language, and their lengths."""
        sums = np.zeros((len(texts), len(self.languages)))
        pad = np.full(ORDER - 1, _SPACE, np.uint32)
        room = max(10_000, _CELLS_AT_ONCE // max(1, len(self.languages)))
        some: list[np.ndarray] = []
        owners: list[tuple[int, int, int]] = []  # text, first and last place of its characters
        size = 0

        def finish():
            nonlocal some, owners, size
            if owners:
                logs = self._logs(np.concatenate(some))
                for k, a, b in owners:
                    sums[k] += logs[a:b].sum(axis=0, dtype=np.float64)
            some, owners, size = [], [], 0

        for k, codes in enumerate(texts):
            for at in range(0, len(codes), room):  # a long text in parts that overlap by their contexts
                part = codes[at : at + room]
                part = np.concatenate([pad if at == 0 else codes[at - ORDER + 1 : at], part])
                if size + len(part) > room:
                    finish()
                owners.append((k, size, size + len(part) - ORDER + 1))
                some.append(part)
                size += len(part)
        finish()
        lengths = np.array([len(x) for x in texts])
        return -sums / np.maximum(lengths, 1)[:, None], lengths

    def _margins(self, entropy: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if len(self.languages) == 1:
            return np.sqrt(lengths)
        two = np.partition(entropy, 1, axis=1)[:, :2]
        return (two[:, 1] - two[:, 0]) * np.sqrt(lengths)

    def predict(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language (-1: no letter), confidence, and whether that is rejected."""
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, lengths = self.entropies(texts)
        best = entropy.argmin(axis=1)
        sure = 1 / (1 + np.exp(-np.clip(self.slope * self._margins(entropy, lengths) + self.offset, -500, 500)))
        far = np.zeros(len(texts), bool)
        if self.limits is not None:
            far = (lengths >= 50) & (entropy[np.arange(len(texts)), best] > self.limits[best])
        none = lengths == 0
        return np.where(none, -1, best), np.where(none, 0.0, sure), none | far | (sure < self.accept)

    def calibrate(self, texts: list[np.ndarray], owners: np.ndarray, precision: float) -> None:
        """Fit the confidence, and from where on a prediction is accepted, on texts of known languages."""
        pieces, known = [], []
        for codes, owner in zip(texts, owners):
            for n in _PIECES:
                if len(codes) >= n:
                    pieces.append(codes[:n] if n % 3 else codes[-n:])
                    known.append(owner)
            pieces.append(codes)
            known.append(owner)
        if not pieces:
            return
        entropy, lengths = self.entropies(pieces)
        best, margin = entropy.argmin(axis=1), self._margins(entropy, lengths)
        right = (best == np.array(known)).astype(float)
        x = np.stack([margin, np.ones(len(margin))], axis=1)
        theta = np.array([1.0, 0.0])
        ridge = np.diag([1e-3, 1e-3]) * len(x) / 100 + np.eye(2) * 1e-6
        for _ in range(50):  # Newton's method for a penalised logistic regression
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (right - p) - ridge @ theta)
            theta = theta + step
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = max(float(theta[0]), 1e-3), float(theta[1])
        sure = 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))
        order = np.argsort(-sure, kind="stable")
        correct = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(correct >= precision)
        self.accept = float(sure[order[good[-1]]]) if len(good) else 1.0
        own = entropy[np.arange(len(pieces)), best]
        long = (lengths >= 50) & (right > 0)
        self.limits = np.array(
            [own[long & (best == k)].max() * 1.1 if (long & (best == k)).any() else np.inf for k in range(len(self.languages))]
        )


def assemble(counted: dict[str, tuple[np.ndarray, np.ndarray]]) -> LanguageModel:
    """Model from each language's different 5-grams (rows of code points) and their counts."""
    languages = sorted(counted)
    orders = [_orders(*counted[x]) for x in languages]
    characters = len(np.unique(np.concatenate([o[0].grams for o in orders]))) + 1  # and one for unknown ones
    model = LanguageModel(languages, [], [], np.full(len(languages), -np.log(characters), np.float32))
    lower = np.full((1, len(languages)), 1 / characters)
    for n in range(ORDER):
        own = [o[n] for o in orders]
        hashes, grams, _, _ = _unique(np.concatenate([o.grams for o in own]))
        contexts = np.unique(np.concatenate([o.contexts for o in own]))
        if n:
            lower = lower[np.searchsorted(model.grams[-1][0], _gram_hashes(grams[:, 1:]))]
            ends = _gram_hashes(grams[:, :-1])
        else:
            ends = np.zeros(len(grams), np.uint64)
        left = np.stack([_look_up(o.contexts, o.left, ends, 1.0) for o in own], axis=1)
        lower = np.stack([_look_up(o.hashes, o.shares, hashes, 0.0) for o in own], axis=1) + left * lower
        weights = np.stack([_look_up(o.contexts, o.left, contexts, 1.0) for o in own], axis=1)
        model.grams.append((hashes, np.log(lower).astype(np.float32)))
        model.contexts.append((contexts, np.log(weights).astype(np.float32)))
    return model


def fold_of(doc_id: Column) -> Column:
    """Third of a document, from its id; null without one."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def _sample(known: DataFrame, max_chars: int, scratch: Scratch) -> DataFrame:
    """Whole texts per language in the order of their ids' hashes, while they stay within ``max_chars``
    characters together (the first one in any case). A share by hash comes before, so that no language is
    sorted whole."""
    sizes = known.groupBy("lang").agg(F.sum("size").alias("total"))  # at most MAX_LANGUAGES rows
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = known.join(F.broadcast(sizes), "lang").withColumn("share", share)
    least = near.groupBy("lang").agg(F.min("share").alias("least"))
    near = near.join(F.broadcast(least), "lang")
    near = near.filter((F.col("share") * F.col("total") < 3.0 * max_chars) | (F.col("share") == F.col("least")))
    order = Window.partitionBy("lang").orderBy("share", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    upto = near.withColumn("up_to", F.sum("size").over(order)).withColumn("n", F.count(F.lit(1)).over(order))
    return upto.filter((F.col("up_to") <= max_chars) | (F.col("n") == 1))


def _grams(texts: DataFrame) -> DataFrame:
    """lang, gram (five code points as bytes) and n of each batch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_language: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = normal_codes(text.as_py())
                if len(codes):
                    padded = np.concatenate([np.full(ORDER - 1, _SPACE, np.uint32), codes])
                    by_language.setdefault(lang, []).append(np.lib.stride_tricks.sliding_window_view(padded, ORDER))
            for lang, found in by_language.items():
                _, grams, counts, _ = _unique(np.concatenate(found))
                width = grams.shape[1] * 4
                flat = pa.py_buffer(np.ascontiguousarray(grams, "<u4"))
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(grams), [None, flat]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), packed, pa.array(counts, pa.int64())], names=["lang", "gram", "n"]
                )

    return texts.select("lang", "text").mapInArrow(run, "lang string, gram binary, n long")


def fit(
    docs: DataFrame, max_chars: int = MAX_CHARS, max_languages: int = MAX_LANGUAGES, precision: float = 0.99,
    scratch: Scratch | None = None,
) -> LanguageModel:
    """Fit on the rows of ``docs`` (doc_id, text, lang) with none of the three null: for each of the at most
    ``max_languages`` most frequent values of lang, whole texts of at most ``max_chars`` characters together
    (fewer with many languages, see ``MAX_CELLS``), chosen by the hash of doc_id. One text in five is held
    back and calibrates; predictions from ``accept`` up were right there in at least ``precision`` of the
    cases. Without rows the model knows no language."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").withColumn("size", F.length("text"))
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).select("lang").collect()
    if not common:
        return LanguageModel([], [], [], np.zeros(0, np.float32))
    max_chars = max(1_000, min(max_chars, MAX_CELLS // len(common) ** 2))
    names = [r.lang for r in common]
    chosen = _sample(rows.filter(F.col("lang").isin(names)), max_chars, scratch)
    held = (F.pmod(F.xxhash64("doc_id", F.lit("held back")), F.lit(5)) == 0) & (F.col("n") > 1)
    sample = scratch.table(chosen.select("doc_id", "lang", "text", held.alias("held")))
    counts = _grams(sample.filter("NOT held")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # no more than the sample has characters
    languages = found.column("lang").to_numpy(zero_copy_only=False)
    grams = np.frombuffer(b"".join(found.column("gram").to_pylist()), "<u4").reshape(-1, ORDER)
    numbers = found.column("n").to_numpy()
    counted = {x: (grams[languages == x], numbers[languages == x]) for x in names if (languages == x).any()}
    if not counted:
        return LanguageModel([], [], [], np.zeros(0, np.float32))
    model = assemble(counted)
    rest = sample.filter(F.col("held") & F.col("lang").isin(model.languages)).orderBy("doc_id", "lang").select("lang", "text").collect()
    place = {x: k for k, x in enumerate(model.languages)}
    model.calibrate([normal_codes(r.text) for r in rest], np.array([place[r.lang] for r in rest], int), precision)
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` (with ``text``) and three columns: lang_pred, score (0 to 1) and rejected.

    lang_pred is the language whose model needs the fewest nats per character for the whole text; ``und``
    with score 0 for null and empty texts, for texts without a letter, and for all when the model knows no
    language. ``rejected`` marks these, and predictions too unsure or too far from their language. Equal
    cross-entropies go to the first name. Columns of these three names are replaced."""
    added = ("lang_pred", "score", "rejected")
    rest = [c for c in docs.columns if c.lower() not in added]
    source = docs.select(*[F.col(f"`{c}`") for c in rest])
    text = [c.lower() for c in rest].index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            codes = [normal_codes(x.as_py()) for x in batch.column(text)]
            best, sure, rejected = model.predict(codes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(sure), pa.array(rejected)], names=[*rest, *added]
            )

    schema = T.StructType(list(source.schema.fields)).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return source.mapInArrow(run, schema)

"""Toxicity as an ordered severity: cumulative-link regression on sparse text features.

P(grade > k) = sigmoid(w . x - t_k) with one weight vector for all thresholds t_0 < t_1 < t_2. Features
are words and word beginnings that tell toxic from clean labelled texts, counted on a bounded sample of
the labelled documents; x is log2(1 + count). Labels only say toxic or not: grade 0 is clean, and toxic
documents are graded 1 to 3 by thirds of how many toxic features they have, so that the thresholds
order them. A document's expected severity is the sum of P(grade > k).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.scratch import Scratch

BEGINNING = 4
THRESHOLDS = 3
_ROWS = 200
_WORD = re.compile(r"\w+")


def features_of(text: str | None) -> Counter:
    """Counts of lower-cased words, and of the beginnings of longer ones (marked with a star)."""
    words = _WORD.findall((text or "").lower())
    found = Counter(words)
    found.update(w[:BEGINNING] + "*" for w in words if len(w) > BEGINNING)
    return found


def signature(words: list[str]) -> int:
    """Least hash of the five-word shingles: mostly the same for near copies, else different."""
    shingles = (" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4)))
    return min(xxhash.xxh64_intdigest(x) for x in shingles) >> 1


@dataclass
class SeverityModel:
    """Weights of the features and ascending thresholds. Without features nothing is toxic."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > 0), P(grade > 1), P(grade > 2) for each text."""
        out = np.zeros((len(texts), THRESHOLDS))
        if not self.weights:
            return out
        words = {f: w for f, w in self.weights.items() if not f.endswith("*")}
        begins = {f[:-1]: w for f, w in self.weights.items() if f.endswith("*")}
        for k, text in enumerate(texts):
            count: Counter = Counter()
            for word in _WORD.findall((text or "").lower()):
                if word in words:
                    count[word] += 1
                if len(word) > BEGINNING and word[:BEGINNING] in begins:
                    count[word[:BEGINNING] + "*"] += 1
            out[k] = sum(self.weights[f] * np.log2(1 + n) for f, n in count.items())
        return 1 / (1 + np.exp(np.clip(self.thresholds - out, -500, 500)))


def fit_thresholds(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int,
    ridge: float = 0.02, steps: int = 1_200, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (none below 0: a feature only adds severity) and thresholds of the cumulative-link model, by
    penalised maximum likelihood (Adam on all rows, its rate falling to nothing). ``rows``, ``columns``,
    ``values`` are the entries of the sparse feature matrix."""
    n = len(grades)
    l2 = ridge / n
    # first threshold and logarithms of the gaps keep the order
    theta = np.concatenate([np.zeros(n_features), [2.0], np.zeros(THRESHOLDS - 1)])
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    below = np.arange(n)
    for step in range(1, steps + 1):
        w, free = theta[:n_features], theta[n_features:]
        cuts = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        eta = np.bincount(rows, weights=values * w[columns], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(cuts[None, :] - eta[:, None], -40, 40)))  # P(grade <= k)
        full = np.hstack([np.zeros((n, 1)), p, np.ones((n, 1))])
        slope = full * (1 - full)
        like = np.maximum(full[below, grades + 1] - full[below, grades], 1e-12)
        up, low = slope[below, grades + 1] / like, slope[below, grades] / like
        d_eta = (up - low) / n  # of the negative log-likelihood
        d_cut = np.array([low[grades == k + 1].sum() - up[grades == k].sum() for k in range(THRESHOLDS)]) / n
        tail = np.cumsum(d_cut[::-1])[::-1]
        gradient = np.concatenate(
            [np.bincount(columns, weights=values * d_eta[rows], minlength=n_features) + l2 * w, tail * np.concatenate([[1.0], np.exp(free[1:])])]
        )
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        pace = rate * (1 + np.cos(np.pi * step / steps)) / 2
        theta -= pace * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        np.maximum(theta[:n_features], 0, out=theta[:n_features])
    free = theta[n_features:]
    return theta[:n_features], np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_features: int = 2_000, least_share: float = 0.01,
    scratch: Scratch | None = None,
) -> SeverityModel:
    """Fit on at most ``max_labelled`` labelled documents (smallest hashes of doc_id) and the at most
    ``max_features`` features that tell most, of those in four and in ``least_share`` of the toxic ones
    (words of a few copies of one document are in neither). Rows of ``labels`` (doc_id, toxic)
    with a null are left out; without toxic or without clean documents the model has no features."""
    scratch = scratch or Scratch(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long"), (F.col("toxic") > 0).cast("int").alias("toxic")).dropna()
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("f", pa.string()), ("n", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                texts = some.column(2).to_pylist()
                lists = [[{"f": f, "n": n} for f, n in features_of(t).items()] for t in texts]
                copies = [signature((t or "").lower().split()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(copies, pa.int64()), pa.array(lists, kind)],
                    names=["doc_id", "toxic", "copy", "features"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")  # max_labelled rows
    read = scratch.table(
        texts.select("doc_id", "toxic", "text").mapInArrow(extract, "doc_id long, toxic int, copy long, features array<struct<f:string,n:int>>")
    )
    sizes = dict(read.groupBy("toxic").agg(F.count_distinct("copy")).collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return SeverityModel({}, np.arange(1.0, THRESHOLDS + 1))
    once = read.select("toxic", "copy", F.explode("features.f").alias("f")).distinct()  # near copies count once
    counts = once.groupBy("f").agg(F.sum("toxic").alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (clean - F.col("b") + 0.5))
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5) + 1 / (toxic - F.col("a") + 0.5) + 1 / (clean - F.col("b") + 0.5))
    telling = (
        counts.filter(F.col("a") >= max(4, least_share * toxic)).select("f", odds.alias("odds"), (odds / error).alias("z"))
        .filter("odds > 2 AND z > 2.6").orderBy(F.desc("z"), "f").limit(max_features)
    )
    index = {r.f: k for k, r in enumerate(telling.collect())}
    if not index:
        return SeverityModel({}, np.arange(1.0, THRESHOLDS + 1))
    chosen = F.filter("features", lambda x: x["f"].isin(list(index)))
    data = read.select("toxic", chosen.alias("features")).collect()
    rows, columns, values, hits = [], [], [], np.zeros(len(data))
    for k, r in enumerate(data):
        for x in r.features:
            rows.append(k)
            columns.append(index[x.f])
            values.append(np.log2(1 + x.n))
            hits[k] += x.n
    is_toxic = np.array([r.toxic for r in data], dtype=bool)
    cuts = np.quantile(hits[is_toxic], [1 / 3, 2 / 3])
    grades = np.where(is_toxic, 1 + np.searchsorted(cuts, hits, side="left"), 0)
    weights, thresholds = fit_thresholds(np.array(rows), np.array(columns), np.array(values), grades, len(index))
    return SeverityModel({f: float(weights[k]) for f, k in index.items()}, thresholds)


def grade(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """``docs`` with p_toxic (P(grade > 0)) and expected_severity (0 to 3) added; null text is empty and has
    no features. Columns of these names, in any case, are replaced."""
    rest = [c for c in docs.columns if c.lower() not in ("p_toxic", "expected_severity")]
    source = docs.select(*[F.col(f"`{c}`") for c in rest])
    text = [c.lower() for c in rest].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p[:, 0]), pa.array(p.sum(axis=1))], names=[*rest, "p_toxic", "expected_severity"]
            )

    schema = T.StructType(list(source.schema.fields)).add("p_toxic", "double").add("expected_severity", "double")
    return source.mapInArrow(run, schema)

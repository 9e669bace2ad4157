"""Importance resampling against a row-by-row evaluation."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string"


def features(text, buckets):
    words = WORD.findall((text or "").translate(CAPITALS))
    grams = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), Counter(crc32(g.encode()) % buckets for g in grams)


def expected(docs, target, percent=5, least=20, buckets=10_000):
    found = [(d, *features(t, buckets)) for d, t in docs]
    source, wanted = Counter(), Counter()
    for _, _, f in found:
        source.update(f)
    for t in target:
        wanted.update(features(t, buckets)[1])
    a, b = sum(source.values()) + buckets, sum(wanted.values()) + buckets
    gain = [math.floor(1000 * math.log((wanted[k] + 1) * a / ((source[k] + 1) * b))) for k in range(buckets)]
    out = []
    for d, n, f in found:
        weight = sum(gain[k] * c for k, c in f.items())
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, sum(f.values()), weight, weight + noise, None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def made(n):
    words = ["Alpha", "béta", "x1", "über", "ZETA", "eta", "日本", "nu"]
    return [(k, " ".join(words[(k * 7 + j * (k % 5 + 1)) % 8] for j in range(k % 60))) for k in range(n)]


@pytest.mark.parametrize("percent", [5, 37, 100])
def test_scores_and_ranks(spark, percent):
    docs = made(300)
    target = ["Alpha béta alpha beta", "über ZETA-eta, nu", None]
    got = resample.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(t,) for t in target], "text string"), percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(got) == expected(docs, target, percent)


def test_odd_rows(spark):
    long = "word " * 300_000
    docs = [(1, None), (2, ""), (None, "a b " * 20), (4, "... !!"), (5, long), (6, "ÀB" * 5_000), (None, None)]
    docs += [(9, "same row " * 30)] * 20  # one score, one id
    target = ["same row"]
    source = spark.createDataFrame(docs, DOCS)
    noisy = source.withColumns({c: F.lit(7) for c in ("row", "rank", "score", "part", "base", "buckets")})
    got = resample.resample(noisy, spark.createDataFrame([(t,) for t in target], "text string"), 50)
    assert rows(got) == expected(docs, target, 50)


@pytest.mark.parametrize("docs,target", [([], ["a b"]), ([(1, "a b c")], []), ([], [])])
def test_empty_tables(spark, docs, target):
    got = resample.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(t,) for t in target], "text string"))
    assert rows(got) == expected(docs, target)


def test_one_score_for_all(spark):
    """A tie of all rows is cut by id, in as many jobs as the ids have halvings."""
    frame = spark.range(5000).select(F.col("id").alias("key"), F.lit(3).alias("tie"))
    first = frame.filter(resample.first_rows(frame, [F.col("tie"), -F.col("key")], 17))
    assert rows(first.select("key")) == sorted([(k,) for k in range(4983, 5000)], key=repr)


@pytest.mark.parametrize("place", [1, 2, 50, 99, 100])
def test_value_at(spark, place):
    values = sorted((k * 7919) % 1000 - 500 for k in range(100))
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    value, below = resample.value_at(frame, F.col("v"), place)
    assert (value, below) == (values[place - 1], sum(v < values[place - 1] for v in values))

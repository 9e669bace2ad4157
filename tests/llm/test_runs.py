"""Periodic runs against a scan of every lag."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import runs


def all_runs(words, least_words=6, least_periods=4):
    found = {}
    for q in range(1, len(words) // least_periods + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def by_start(found):
    return sorted(found, key=lambda r: (r[0], r[2]))


def check(texts, **options):
    got = runs.find_runs(texts, options.get("least_words", 6), options.get("least_periods", 4), options.get("direct", 8))
    for words, (own, keep) in zip(texts, got):
        want = all_runs(words, options.get("least_words", 6), options.get("least_periods", 4))
        assert [tuple(r) for r in own.tolist()] == by_start(want)
        assert [words[k] for k in keep] == collapsed(words, want)


@pytest.mark.parametrize("direct", [1, 2, 8])
@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_random_texts(direct, letters):
    rng = random.Random(letters)
    texts = [[b"%d" % rng.randrange(letters) for _ in range(rng.randrange(120))] for _ in range(150)]
    check(texts, direct=direct)


@pytest.mark.parametrize("direct", [1, 8])
def test_planted_periods(direct):
    """Every period up to 150, with repeats inside the period, broken copies and neighbouring runs."""
    rng = random.Random(5)
    texts = []
    for q in range(1, 151):
        period = [b"%d" % rng.randrange(max(2, q // 3)) for _ in range(q)]
        head, tail = ([b"%d" % rng.randrange(50) for _ in range(rng.randrange(40))] for _ in range(2))
        stretch = (period * 8)[: rng.randrange(4 * q - 2, 6 * q + 1)]
        if q % 4 == 0:
            stretch[len(stretch) // 2] = b"broken"
        texts.append(head + stretch + tail + period * (q % 7))
    check(texts, direct=direct)


def test_structured_words():
    fibonacci, thue = [b"a"], [b"a"]
    before = [b"b"]
    while len(fibonacci) < 600:
        fibonacci, before = fibonacci + before, fibonacci
    while len(thue) < 1024:
        thue = thue + [b"b" if w == b"a" else b"a" for w in thue]
    check([fibonacci, thue, (fibonacci[:89] + thue[:40]) * 9, thue * 4], direct=2)


def test_other_lengths():
    rng = random.Random(1)
    texts = [[b"%d" % rng.randrange(2) for _ in range(80)] for _ in range(60)]
    check(texts, least_words=12, least_periods=5)
    with pytest.raises(ValueError):
        runs.runs_of(np.array([0, -1]), [1], least_periods=3)


def test_documents(spark):
    long = "a b c " * 200_000 + "end"
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (4, "x x x x x"), (5, "x x x x x x"), (6, long), (None, "y\tz\x0by z\ny z y  z"),
        (6, long), (8, "p q " * 9), (9, "\x1f \x1f \x1f \x1f \x1f \x1f"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"RUNS": F.lit(1), "other": F.lit("o")})
    got = runs.periodic_runs(frame)
    assert got.columns == ["doc_id", "text", "other", "runs", "collapsed"]
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()]
    want = []
    for d, t in docs:
        words = (t or "").encode().split()
        own = [(0, 600_000, 3)] if t == long else by_start(all_runs(words))
        want.append((d, own, b" ".join(collapsed(words, own)).decode()))
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert rows(runs.periodic_runs(frame.filter("false"))) == []

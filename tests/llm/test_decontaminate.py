from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import decontaminate
from tidemark.llm.decontaminate import Windows

DOCS = "doc_id long, text string, item_id string, begin string, edits string, _normalised string"


def plain(text):
    return " ".join(re.findall(r"[^\W_]+", (text or "").lower())).encode()


def least_edits(pattern, text):
    """Edit distance of the pattern to the closest stretch of the text."""
    row = np.zeros(len(text) + 1, dtype=int)
    codes = np.frombuffer(text, np.uint8)
    steps = np.arange(len(text) + 1)
    for p in pattern:
        new = np.minimum(row + 1, np.concatenate([[row[0] + 1], row[:-1] + (codes != p)]))
        row = np.minimum.accumulate(new - steps) + steps
    return row.min()


def windows_of(text):
    n = len(text)
    w = min(n, 128, max(36, n * 3 // 8))
    return [text[a : a + w] for a in sorted({*range(0, n - w, max(w // 4, 1)), n - w})] if n >= decontaminate.Q else []


def budget_of(window):
    """Most edits, up to 7 %, at which the q-gram lemma asks for a quarter of the window's bytes; 0 if none."""
    n = len(window)
    allowed = [e for e in range(int(n * decontaminate.EDITS) + 1) if n + 1 - decontaminate.Q * (e + 1) >= n // 4]
    return max(allowed, default=0)


def brute(docs, items):
    found = set()
    for doc_id, text in docs:
        for item_id, item in items:
            n = 0
            for w in windows_of(plain(item)):
                n += least_edits(w, plain(text)) <= budget_of(w)
            if n:
                found.add((doc_id, item_id, n))
    return found


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Thin", "ered", "tion", "ént", "or", "an"]
    word = lambda: "".join(rng.choices(vocabulary, k=rng.randint(1, 3)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.choice([4, 12, 30, 60])) + ".") for i in range(12)] + [(50, "short"), (51, None), (52, "")]
    docs = []
    for i in range(70):
        parts = [text(rng.randint(0, 60))]
        if i % 2:
            passage = list(rng.choice(items[:12])[1])
            for _ in range(rng.choice([0, 0, 2, 6, 14])):
                k = rng.randrange(len(passage))
                passage[k] = rng.choice(["", "x", passage[k] + "y", passage[k].upper()])
            passage = "".join(passage)
            if i % 6 == 1:
                passage = passage[rng.randrange(20) :].replace(" ", ",\n ")
            parts += [passage, text(rng.randint(0, 30))]
        docs.append((i, " ".join(parts)))
    return docs + [(90, None), (91, ""), (92, "short"), (None, items[3][1] + " tail"), (93, items[2][1]), (93, items[2][1])], items


def frames(spark, docs, items):
    rows = spark.createDataFrame([(*d, "x", "x", "x", "x") for d in docs], DOCS).repartition(3)
    return rows, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 18, 300])
def test_matches_equal_full_alignment(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = corpus(6)
    rows, benchmark = frames(spark, docs, items)
    got = decontaminate.contaminated(rows, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.windows) for r in got} == brute(docs, items)
    assert len(got) == len(brute(docs, items)) + 1  # the repeated row
    held = {d: plain(t) for d, t in docs}
    for r in got:
        assert 0 <= r.begin < r.end <= len(held[r.doc_id]) + 1 and 0 <= r.edits <= 8
    clean = decontaminate.drop_contaminated(rows, benchmark)
    assert clean.schema == rows.schema
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _, _ in brute(docs, items)}


def test_bands_lose_no_alignment():
    rng = random.Random(9)
    item = bytes(rng.choices(b"abcdefgh ", k=300))
    found = Windows([(1, item)])
    for _ in range(60):
        part = bytearray(item[100:260])
        for _ in range(rng.randint(0, 12)):
            k = rng.randrange(len(part))
            part[k : k + rng.choice([0, 1, 1, 2])] = rng.choice([b"", b"z", b"zz"])
        text = bytes(rng.choices(b"abcdefgh ", k=rng.randint(0, 200))) + bytes(part) + bytes(rng.choices(b"abcdefgh ", k=50))
        n = sum(least_edits(w, text) <= budget_of(w) for w in windows_of(item))
        assert sum(m[2] for m in found.matches([b"", text])) == n


def test_long_text_and_nothing(spark):
    docs, items = corpus(2)
    long = "filler words " * 90_000 + items[4][1] + " more" * 1000
    rows, benchmark = frames(spark, [(1, long), (2, "x" * 500_000)], items)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(rows, benchmark).collect()} == {(1, 4)}
    assert decontaminate.contaminated(rows, benchmark.limit(0)).collect() == []
    assert decontaminate.contaminated(rows.limit(0), benchmark).collect() == []
    assert decontaminate.drop_contaminated(rows, benchmark.limit(0)).count() == 2


def test_halves_are_found():
    rng = random.Random(4)
    words = lambda n: bytes(" ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n)), "ascii")
    items = [(i, words(rng.randint(17, 120))) for i in range(60)]
    found = Windows(items)
    for i, item in items:
        for begin in (0, len(item) // 4, len(item) // 2):
            text = words(40) + b" " + item[begin : begin + len(item) // 2] + b" " + words(40)
            if len(item) >= 88:
                assert [m[1] for m in found.matches([text])] == [i]
        long = item[50 : 50 + 160]
        if len(long) == 160:
            assert [m[1] for m in found.matches([words(9) + long + words(9)])] == [i]
    assert found.matches([words(3000)]) == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "x " * 5, "a", 1), (2, None, None, None)], "doc_id long, text string, Normalised string, windows long")
    items = spark.createDataFrame([(1, "seven words of an item that is long enough to tell")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.schema == docs.schema and kept.count() == 2
    assert decontaminate.contaminated(docs, items).columns == ["doc_id", "item_id", "windows", "begin", "end", "edits"]

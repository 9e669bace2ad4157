from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import queries, repeats

SCHEMA = "doc_id long, text string, key string, at string, size string, n_chars int"


def brute(rows, length, keep_first):
    """Removed byte positions of each row; with keep_first, rows equal in doc_id and text are one."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    texts = [(r[1] or "").encode() for r in rows]
    places = defaultdict(list)
    for i in order:
        for k in range(len(texts[i]) - length + 1):
            places[texts[i][k : k + length]].append((i, k))
    removed = [set() for _ in rows]
    for where in places.values():
        if len(where) > 1:
            first = {p for p in where if keep_first and (rows[p[0]] == rows[where[0][0]] and p[1] == where[0][1])}
            for i, k in where:
                if (i, k) not in first:
                    removed[i] |= set(range(k, k + length))
    return texts, removed


def expected(rows, length, keep_first):
    out = []
    for (doc_id, _), text, gone in zip(rows, *brute(rows, length, keep_first)):
        spans = sum(1 for k in gone if k - 1 not in gone)
        kept = bytes(b for k, b in enumerate(text) if k not in gone)
        out.append((doc_id, len(text), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 90))) for _ in range(n)]
    passage = " ".join(word() for _ in range(40))
    for i in range(0, n, 3):
        k = rng.randrange(len(texts[i]) + 1)
        a = rng.randrange(60)
        texts[i] = texts[i][:k] + passage[a : a + rng.randint(30, 200)] + texts[i][k:]
    texts[5] = texts[4] + texts[4]
    texts[7], texts[8] = texts[6], texts[6]
    texts[9] = "a" * 300
    texts[10] = texts[11][:-1] + "x"
    rows = [(rng.choice([i, i + 1000]), t) for i, t in enumerate(texts)]
    return rows + [(7777, None), (7778, ""), (None, texts[6]), rows[12], rows[12], rows[15]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("few", [2_000, 1])
def test_against_brute_force(spark, monkeypatch, keep_first, few):
    monkeypatch.setattr(repeats, "FEW_SEGMENTS", few)
    rows = corpus(3)
    got = repeats.digests(frame(spark, rows), 48, keep_first).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == expected(rows, 48, keep_first)
    for r in got:  # the text that is left: all bytes, but for characters that are covered in part
        left = hashlib.sha256(r.text.encode()).hexdigest()
        assert left == r.kept_sha256 or 0 < len(r.text.encode()) - (r.n_bytes - r.n_removed) <= 6 * r.n_spans


@pytest.mark.parametrize("few", [2_000, 1])
def test_later_places_are_told_from_first_ones(spark, monkeypatch, few):
    monkeypatch.setattr(repeats, "FEW_SEGMENTS", few)
    rows = corpus(4)
    got = repeats.digests(frame(spark, rows), 48).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_later) for r in got), key=repr) == sorted((e[:3] for e in expected(rows, 48, True)), key=repr)
    assert any(0 < r.n_later < r.n_removed for r in got) and any(r.n_later == 0 < r.n_removed for r in got)


def whole_characters_left(text, gone):
    """The text without the characters of which all bytes go."""
    out, at = [], 0
    for c in text or "":
        size = len(c.encode())
        if not set(range(at, at + size)) <= gone:
            out.append(c)
        at += size
    return "".join(out)


@pytest.mark.parametrize("few", [2_000, 1])
def test_deduplicated_text_keeps_the_first_place(spark, monkeypatch, few):
    monkeypatch.setattr(repeats, "FEW_SEGMENTS", few)
    rows = corpus(5)
    inner = corpus(6)[0][1] + "é" * 60  # a text with copies that repeats a string of its own and an earlier one
    rows += [(8000, inner + " " + inner + rows[0][1]), (8001, inner + " " + inner + rows[0][1])]
    got = repeats.digests(frame(spark, rows), 48).collect()
    for keep_first, column in [(True, "deduplicated"), (False, "text")]:
        left = [(r[0], whole_characters_left(r[1], gone)) for r, gone in zip(rows, brute(rows, 48, keep_first)[1])]
        assert sorted(((r.doc_id, r[column]) for r in got), key=repr) == sorted(left, key=repr)
    assert any(r.n_removed > 0 and r.deduplicated != r.text for r in got) and any(0 < r.n_later < r.n_removed == r.n_bytes for r in got)


def test_query_leaves_first_holders_of_passages_alone(spark, tmp_path):
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(6, 9))) for _ in range(n))
    passage, alone, copied = words(70), words(90), words(80)
    rows = [(1, words(9) + " " + passage), (2, alone), (3, f"{words(5)}# {passage} #{words(6)}"), (4, copied), (5, copied), (6, None)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op7_suffix_repeats"](spark, str(tmp_path)).collect()}
    assert [got[k].text for k in (1, 2, 4)] == [rows[0][1], alone, copied]
    assert passage not in got[3].text and rows[2][1].startswith(got[3].text.split("#")[0]) and got[5].text == got[6].text == ""
    assert passage not in got[1].left and got[4].left == "" and got[2].left == alone
    for r in got.values():  # the digest columns are of what is left without all places
        assert hashlib.sha256(r.left.encode()).hexdigest() == r.kept_sha256 and len(r.left) == r.n_bytes - r.n_removed


def test_texts_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK", 500)
    rows = corpus(8, 30) + [(9000, corpus(9)[0][1] * 40), (9001, "é" * 900)]
    got = repeats.digests(frame(spark, rows), 64, True).drop("text").collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, 64, True)


def test_remove_repeats_keeps_columns_and_characters(spark):
    rows = corpus(4)
    docs = frame(spark, rows)
    got = repeats.remove_repeats(docs, 48)
    assert got.schema.simpleString() == docs.schema.simpleString()
    texts, removed = brute(rows, 48, True)
    whole = defaultdict(list)
    for (doc_id, _), text, gone in zip(rows, texts, removed):
        whole[doc_id].append((text, len(text) - len(gone), not gone))
    found = got.collect()
    for r in found:
        assert any(0 <= len((r.text or "").encode()) - left <= 8 or text == (r.text or "").encode() for text, left, _ in whole[r.doc_id])
    untouched = sorted(repr(r[0]) for r, gone in zip(rows, removed) if not gone)
    assert set(untouched) <= {repr(r.doc_id) for r in found}


def test_suffix_order_against_sorting():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(50, 90))) for _ in range(12)]
    texts[3] = texts[2][5:]
    owners = np.array([list(range(12))[::-1], [0] * 12])
    of, inside, earlier, later = repeats.equal_windows(texts, owners, 50)
    windows = [(t[k : k + 50], owners[0][i], k, i) for i, t in enumerate(texts) for k in range(len(t) - 49)]
    windows.sort()
    assert [(w[3], w[2]) for w in windows] == list(zip(of.tolist(), inside.tolist()))
    assert earlier.tolist() == [k > 0 and windows[k][0] == windows[k - 1][0] for k in range(len(windows))]
    assert later.tolist()[:-1] == earlier.tolist()[1:]


def test_nothing_and_short_windows(spark):
    docs = frame(spark, corpus(1)).limit(0)
    assert repeats.digests(docs).collect() == [] and repeats.remove_repeats(docs).collect() == []
    assert repeats.remove_repeats(frame(spark, [(1, "a"), (2, None)])).count() == 2
    with pytest.raises(ValueError):
        repeats.digests(docs, 47)

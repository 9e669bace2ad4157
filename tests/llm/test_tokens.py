from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, token_files
from tidemark.llm.encoder import Encoder
from tidemark.llm.tables import new_folder

FILE = path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(FILE)
TEXTS = ["", None, "a", " \t\n", "Hello, WORLD's  end…", "é é İ ΣΑΣ ﬁ", "x" * 5000, "a\x1cb c\u0085d",
         "<|endoftext|> <|startoftext|>x", "<|ENDOFTEXT|> End. end., a.b, x.\u00a0y é. 5, (a). \u0130. A\u0301, b,", "It's. THE'RE, 'S.", "it 's we'll 12 3.5 你好 😀😀", "word " * 3000]
DOCS = "doc_id long, text string, piece string, length string"


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def encoded(texts):
    e = Encoder(FILE, remembered=3)
    return [np.frombuffer(x, e.dtype).tolist() for x in e.encode([t.encode() if t is not None else t for t in texts])]


def test_encoder_equals_the_tokenizer():
    assert encoded(TEXTS) == [plain(t) for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet="aB1é.,' <|\n\u0301", max_size=30)), max_size=5))
def test_encoder_equals_the_tokenizer_on_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encoded(texts) == [plain(t) for t in texts]


def frame(spark, texts):
    rows = [(i * 3 % 31 if i else None, t, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[3:5], DOCS).repartition(3)


def test_token_files_round_trip(spark):
    docs = frame(spark, TEXTS)
    folder = new_folder(spark, "t")
    token_files.write_tokens(docs, folder, FILE)
    got = sorted(token_files.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda x: -1 if x is None else x)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    expected = sorted((-1 if r.doc_id is None else r.doc_id, plain(r.text) + [2]) for r in docs.collect())
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in got) == expected


def test_token_files_of_nothing(spark):
    folder = new_folder(spark, "t")
    token_files.write_tokens(frame(spark, TEXTS).limit(0), folder, FILE)
    assert token_files.read_tokens(spark, folder).collect() == []


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_packing_is_whole_and_gapless(spark, capacity):
    docs = frame(spark, TEXTS)
    pieces = packing.cut_pieces(docs, FILE, capacity, with_ids=True)
    rows = packing.pack(pieces, capacity).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault((-1 if r.doc_id is None else r.doc_id), []).append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 <= capacity
        assert r.start == r.piece * capacity
    for d in docs.collect():
        parts = sorted({(r.piece, bytes(r.ids)) for r in by_doc[-1 if d.doc_id is None else d.doc_id]})
        assert np.frombuffer(b"".join(p for _, p in parts), "<u4").tolist() == plain(d.text) + [0]
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    whole = packing.sequences(packing.pack(pieces, capacity)).collect()
    assert len(whole) == len(by_sequence) and all(len(r.ids) == 4 * r.length for r in whole)


def test_packing_nothing_and_bad_lengths(spark):
    empty = packing.cut_pieces(frame(spark, TEXTS).limit(0), FILE, 16)
    assert packing.pack(empty, 16).collect() == []
    with pytest.raises(ValueError):
        packing.plan_sequences({17: 1}, 16)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 200), st.integers(1, 400), min_size=1, max_size=60))
def test_plan_keeps_the_histogram_and_is_near_the_bound(histogram):
    held, used = {}, 0
    for lengths, n in packing.plan_sequences(histogram, 200):
        assert sum(lengths) <= 200 and n > 0
        used += n
        for x in lengths:
            held[x] = held.get(x, 0) + n
    assert held == histogram
    at_least = -(-sum(k * v for k, v in histogram.items()) // 200)
    large = sum(v for k, v in histogram.items() if k > 100)
    assert used <= 11 / 9 * max(at_least, large) * 1.2 + 2


def test_least_squares_against_its_conditions():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((6, 15)), rng.random(6) * 10
        x = packing.non_negative_least_squares(a, b)
        gradient = a.T @ (a @ x - b)
        assert (x >= 0).all() and (gradient > -1e-6).all() and np.abs(gradient * x).max() < 1e-5


def test_equal_lengths_share_slots(spark):
    pieces = spark.range(20000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(5).cast("long").alias("length"))
    packed = packing.pack(pieces, 17)
    assert packed.count() == 20000 and packed.select("sequence_id", "offset").distinct().count() == 20000
    assert packed.select("sequence_id").distinct().count() == 6667

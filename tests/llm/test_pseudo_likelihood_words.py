from __future__ import annotations

import numpy as np

from tidemark.llm import pseudo_likelihood as pl
from tidemark.scratch import Scratch

DOCS = "doc_id long, text string"


def test_every_word_is_a_target_by_default(spark):
    hashes = pl.word_hashes(spark.createDataFrame([(1, "a b c"), (2, "a")], DOCS).coalesce(1))
    counts = pl.count_buckets(pl.count_words(hashes))
    trained = pl.fit(hashes, counts)
    assert not np.array_equal(trained.flat(), pl.WindowNetwork.start(counts).flat())
    assert np.array_equal(trained.flat(), pl.fit(hashes, counts, every=1).flat())


def test_the_model_is_the_mean_of_the_partitions(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a x")], DOCS)
    both = pl.word_hashes(docs.repartitionByRange(2, "doc_id"))
    counts = pl.count_buckets(pl.count_words(both))
    apart = [pl.fit(pl.word_hashes(docs.filter(f"doc_id = {k}").coalesce(1)), counts).flat().astype(float) for k in (1, 2)]
    assert both.rdd.getNumPartitions() == 2
    assert np.allclose(pl.fit(both, counts).flat(), (4 * apart[0] + 2 * apart[1]) / 6, atol=1e-5)


def test_scores_are_over_words(spark, monkeypatch):
    monkeypatch.setattr(pl, "FREQUENT", 3)  # so that most counts come from the table
    monkeypatch.setattr(pl, "LEAST", 2)  # 16 ids, one of them shared
    monkeypatch.setattr(pl, "MOST", 2)
    monkeypatch.setattr(pl, "BUCKETS_PER_ID", 2)
    texts = ["a b c d e f g", "A b c d", "a b h", "x" * 9 + " a", None, "", "a b h"] + [f"r{i} a q{i % 7}" for i in range(40)]
    docs = spark.createDataFrame([(i if i != 2 else None, t) for i, t in enumerate(texts)], DOCS).repartition(2)
    scratch = Scratch(spark)
    table = scratch.table(pl.word_hashes(docs))
    stored = scratch.table(pl.count_words(table))
    of_bucket = pl.count_buckets(stored)
    net = pl.fit(table, of_bucket)
    rows = table.collect()
    words = [w for r in rows for w in r.words]
    ids = {w: int(net.ids[w % 32]) for w in words}
    of_id = {k: sum(ids[w] == k for w in words) for k in ids.values()}
    assert len(set(ids.values())) < len(ids)
    each = net.text_scores(net.ids_of(np.array(words)), np.array([len(r.words) for r in rows]))
    expected = {r.row: (r.doc_id, len(r.words), x + sum(np.log(words.count(w) / of_id[ids[w]]) for w in r.words)) for r, x in zip(rows, each)}
    got = {r.row: (r.doc_id, r.n_words, r.log_prob) for r in pl.score_words(table, stored, net, of_bucket, scratch).collect()}
    assert got.keys() == expected.keys() and len(got) == len(texts)
    for k, (doc_id, n, x) in expected.items():
        assert got[k][:2] == (doc_id, n) and abs(got[k][2] - x) < 1e-3
    monkeypatch.setattr(pl, "fit", lambda *_, **__: net)  # what a fit learns depends on the partitions
    whole = pl.score_documents(docs).collect()
    assert len(whole) == len(texts) and abs(sum(r.log_prob for r in whole) - sum(x for _, _, x in expected.values())) < 0.01
    assert all(r.mean_log_prob is None if not r.n_words else abs(r.mean_log_prob * r.n_words - r.log_prob) < 1e-9 for r in whole)


def test_frequent_words_are_all_above_a_count(spark, monkeypatch):
    counts = spark.createDataFrame([(k, 1 + k // 3) for k in range(300)], "word long, n long")
    for most in (0, 3, 100, 299, 300):
        monkeypatch.setattr(pl, "FREQUENT", most)
        got = sorted(r.word for r in pl.frequent_words(counts).collect())
        assert len(got) <= most and got == list(range(300 - len(got), 300))
        assert len(got) >= most * 0.8 - 3
    assert pl.frequent_words(counts.limit(0)).count() == 0

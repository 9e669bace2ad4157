from __future__ import annotations

import random
import tracemalloc

import numpy as np

from tidemark.llm import pseudo_likelihood as pl

DOCS = "doc_id long, text string, buckets string, n_words string, log_prob string"


W = pl.LEAST
IDS = W**4


def network(seed=1, scale=0.5, w=W):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, pl.BUCKETS_PER_ID * w**4)
    start = pl.WindowNetwork.start(counts, seed)
    return start.with_flat(rng.normal(0, scale, len(start.flat())))


def plain_score(net, words):
    """Log probability of each word's id from the definition, with explicit loops."""
    ids = [int(net.ids[w % len(net.ids)]) for w in words]
    out = []
    for t, target in enumerate(ids):
        total = np.zeros(pl.WIDTH)
        for k, offset in enumerate(pl.OFFSETS):
            near = ids[t + offset] if 0 <= t + offset < len(ids) else IDS
            total += net.embeddings[k][near]
        x = np.tanh(total) @ net.weights
        rest, c = divmod(target, W)
        a, b = divmod(rest, W)
        for values, bias, digit in ((x[: W * W], net.first, a), (x[W * W : -W], net.second[a], b), (x[-W:], net.third[rest], c)):
            y = values + bias
            out.append(y[digit] - y.max() - np.log(np.exp(y - y.max()).sum()))
    return sum(out)


def frame(spark, texts):
    return spark.createDataFrame([(i if i != 2 else None, t, "x", "y", "z") for i, t in enumerate(texts)], DOCS).repartition(2)


def test_scores_equal_the_definition(spark):
    rng = random.Random(3)
    texts = [" ".join(f"W{rng.randrange(900)}" for _ in range(rng.randint(0, 40))) for _ in range(30)]
    texts += [None, "", " \n", "one", "a b", texts[4], texts[4], "long " * 20_000]
    rows = pl.word_hashes(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    sizes = np.array([len(r.words) for r in rows])
    words = np.array([w for r in rows for w in r.words])
    for net in (network(), network(scale=30)):  # exponentials of the second leave the range of floats
        got = net.text_scores(net.ids_of(words), sizes)
        for r, log_prob in zip(rows, got):
            expected = plain_score(net, r.words)
            assert abs(log_prob - expected) < 1e-3 * max(1, abs(expected))


def test_probabilities_sum_to_one():
    net = network()
    context = np.array([[3], [9], [IDS], [70]]).repeat(IDS, axis=1)
    total = np.exp(net.log_probabilities(np.arange(IDS), context).astype(np.float64)).sum()
    assert abs(total - 1) < 1e-3


def test_ids_grow_with_the_corpus():
    sizes = [pl.values_of_digit(n) for n in (0, 10**6, 10**8, 10**10, 10**20)]
    assert sizes == [8, 8, 10, 18, 22]
    ids = pl.ids_by_frequency(np.arange(1_000), 64)
    assert sorted(ids[-60:]) == list(range(60)) and set(ids[:-60]) == {60, 61, 62, 63}


def test_row_sums_of_many_places():
    rng = np.random.default_rng(3)
    at = np.concatenate([rng.integers(0, 900_000, 300), rng.integers(0, 5, 300), rng.integers(65_530, 65_545, 300)])
    values = rng.normal(size=(300, 4))
    places, sums = pl._row_sums(at, values)
    assert np.array_equal(places, np.unique(at))
    for place, row in zip(places, sums):
        assert np.allclose(row, values[np.flatnonzero(at == place) % 300].sum(axis=0))


def test_gradients_against_differences():
    net = network()
    net = pl.WindowNetwork(net.ids, *(p.astype(np.float64) for p in net.parameters()))
    rng = np.random.default_rng(2)
    targets, context = rng.integers(0, IDS, 20), rng.integers(0, IDS + 1, (4, 20))
    grads = net.gradients(targets, context)
    for p, g in zip(net.parameters(), grads):
        for place in rng.choice(np.flatnonzero(g.ravel()), 5):
            old = p.ravel()[place]
            ends = []
            for step in (1e-5, -1e-5):
                p.ravel()[place] = old + step
                ends.append(-net.log_probabilities(targets, context).mean())
            p.ravel()[place] = old
            assert abs((ends[0] - ends[1]) / 2e-5 - g.ravel()[place]) < 1e-5


def test_training_beats_word_shares_on_held_out_text(spark):
    rng = random.Random(7)
    nxt = {f"w{i}": [f"w{(i * 7 + k) % 60}" for k in range(3)] for i in range(60)}

    def text(n):
        w = "w1"
        out = []
        for _ in range(n):
            out.append(w)
            w = rng.choice(nxt[w])
        return " ".join(out)

    docs, held = frame(spark, [text(400) for _ in range(120)]), frame(spark, [text(300) for _ in range(10)])
    hashes = pl.word_hashes(docs)
    counts = pl.count_buckets(pl.count_words(hashes))
    net = pl.fit(hashes, counts, batch=256)
    start = pl.WindowNetwork.start(counts)
    flat = pl.WindowNetwork(start.ids, *(p * (k >= 2) for k, p in enumerate(start.parameters())))  # biases only
    rows = [np.array(r.words) for r in pl.word_hashes(held).collect()]
    score = lambda n: n.text_scores(n.ids_of(np.concatenate(rows)), np.array(list(map(len, rows)))).sum()
    assert score(net) > score(flat) + 1000


def test_counts_cover_all_words_and_nothing(spark):
    docs = frame(spark, ["a A b", "b", None, ""])
    counts = pl.count_buckets(pl.count_words(pl.word_hashes(docs)))
    assert sorted(counts[counts > 0]) == [2, 2]
    empty = docs.limit(0)
    assert pl.score_documents(empty).collect() == []
    blank = pl.score_documents(frame(spark, [None, ""])).collect()
    assert [(r.n_words, r.log_prob, r.mean_log_prob) for r in blank] == [(0, 0.0, None)] * 2


def test_working_memory_does_not_grow_with_the_targets():
    net, rng = network(w=16), np.random.default_rng(4)
    targets, context = rng.integers(0, 16**4, 16_384), rng.integers(0, 16**4 + 1, (4, 16_384))
    tracemalloc.start()
    whole = net.log_probabilities(targets, context)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6e6  # values of digits of all targets at once: 19 MB
    parts = [net.log_probabilities(targets[k : k + 100], context[:, k : k + 100]) for k in range(0, 16_384, 100)]
    assert np.allclose(whole, np.concatenate(parts), atol=1e-4)


def test_gradients_do_not_depend_on_blocks(monkeypatch):
    for net in (network(), network(scale=30)):
        rng = np.random.default_rng(5)
        targets, context = rng.integers(0, IDS, 1_000), rng.integers(0, IDS + 1, (4, 1_000))
        found = []
        for cells in (1, 1 << 20):
            monkeypatch.setattr(pl, "_CELLS", cells)
            found.append(net.gradients(targets, context))
        for one, other in zip(*found):
            assert np.isfinite(one).all() and np.allclose(one, other, atol=1e-5)


def test_row_sums_of_odd_rows_and_none():
    at, values = np.array([7, 2, 7, 2, 9, 7]), np.arange(18, dtype=np.float32).reshape(6, 3)
    places, sums = pl._row_sums(at, values)
    assert places.tolist() == [2, 7, 9] and sums.tolist() == [[12, 14, 16], [21, 24, 27], [12, 13, 14]]
    assert [len(x) for x in pl._row_sums(at[:0], values[:0])] == [0, 0]


def test_frequent_words_are_found():
    rng = np.random.default_rng(6)
    ends = np.array([-(1 << 63), -1, 0, 1, (1 << 63) - 1])
    near = np.arange(200) * 3  # all of one slot
    known = np.unique(np.concatenate([rng.integers(-(1 << 63), (1 << 63) - 1, 5_000), ends, near]))
    words = np.concatenate([rng.choice(known, 3_000), near + 1, ends, rng.integers(-(1 << 63), (1 << 63) - 1, 3_000)])
    got = pl.find_words(words, known, pl.slot_starts(known))
    expected = np.where(np.isin(words, known), np.searchsorted(known, words), -1)
    assert np.array_equal(got, expected)
    assert pl.find_words(words, known[:0], pl.slot_starts(known[:0])).tolist() == [-1] * len(words)
    assert len(pl.find_words(words[:0], known, pl.slot_starts(known))) == 0

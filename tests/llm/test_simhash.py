from __future__ import annotations

import random

import xxhash

from tidemark.llm import components, simhash
from tidemark.scratch import Scratch

SCHEMA = "doc_id long, text string, fp string, label string"


def plain(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(prints):
    """Component of each position, as the set of positions, by all pairs."""
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def sample():
    rng = random.Random(11)
    vocabulary = [f"W{i}é" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 120)))) for i in range(60)]
    for i in range(60, 120):
        w = rows[rng.randrange(60)][1].split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " \t".join(w)))
    return rows + [(500, None), (501, ""), (502, " \n"), (503, rows[3][1].upper()), (3, rows[3][1]), (3, rows[3][1])]


def test_fingerprints_and_components(spark):
    rows = sample()
    docs = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA).repartition(4)
    got = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex().alias("h"), "component_id").collect()
    prints = [plain(t) for _, t in rows]
    label = groups(prints)
    least = {k: min(rows[i][0] for i in range(len(rows)) if label[i] == k) for k in set(label)}
    expected = [(d, f"{p:016x}", least[k]) for (d, _), p, k in zip(rows, prints, label)]
    assert sorted(map(tuple, got)) == sorted(expected)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_links_equal_all_pairs_also_in_long_lists(spark, monkeypatch):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 400:  # crowded halves, so that quarters are searched
        p = rng.choice(sorted(prints)[:50])
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints |= {rng.getrandbits(64) for _ in range(100)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    expected = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for long_list in (3, 10_000):
        monkeypatch.setattr(simhash, "LONG_LIST", long_list)
        got = {frozenset((r.u, r.v)) for r in simhash.near_links(df, Scratch(spark)).collect()}
        assert got == expected


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 200)] + [(5, i) for i in range(300, 400)] + [(7, 7)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    links += links[:30] + [(b, a) for a, b in links[:40]]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    expected = {x: root(x) for link in links for x in link if root(x) != x}
    df = spark.createDataFrame(links, "u long, v long")
    got = components.components(df, Scratch(spark)).collect()
    assert {r.node: r.label for r in got} == expected and len(got) == len(expected)
    assert components.components(df.limit(0), Scratch(spark)).collect() == []


def test_empty_and_null_ids(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(None, "a b c d", "", ""), (9, "a b c d", "", ""), (None, "q", "", "")], SCHEMA)
    got = simhash.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 9), (9, 9), (None, None)], key=repr)
    assert simhash.keep_one(docs).count() == 3

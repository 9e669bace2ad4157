from __future__ import annotations

import random

import corpus_pipeline
from tidemark.llm import repeats

SCHEMA = "doc_id long, text string, n_chars long"


def without_repeats(texts, words):
    """The words left of each text, by explicit loops: the first place of a run of words stays."""
    seen, out = set(), {}
    for i in sorted(texts):
        of = texts[i].split()
        gone = set()
        for k in range(len(of) - words + 1):
            run = tuple(of[k : k + words])
            if run in seen:
                gone.update(range(k, k + words))
            seen.add(run)
        out[i] = [w for k, w in enumerate(of) if k not in gone]
    return out


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 4)))
    text = lambda n: [word() for _ in range(n)]
    texts = {i: text(rng.randint(60, 200)) for i in range(30)}
    for k, n in enumerate([40, 49, 50, 51, 52, 55, 58, 65, 120]):
        passage = text(n)
        texts[100 + 2 * k] = text(70) + passage + text(30)
        texts[101 + 2 * k] = text(rng.randint(0, 90)) + passage + text(rng.randint(0, 90))
    texts[200] = texts[3]
    twice = text(53)
    texts[201] = text(20) + twice + text(20) + twice
    return {i: rng.choice([" ", "\n", "  "]).join(t) for i, t in texts.items()}


def test_runs_of_words_by_hand(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], SCHEMA).repartition(3)
    expected = without_repeats(texts, 51)
    got = {r.doc_id: r for r in repeats.remove_repeated_words(docs, 51).collect()}
    assert {i: r.text.split() for i, r in got.items()} == {i: w for i, w in expected.items() if w}
    assert 200 not in got and all(r.n_chars == len(r.text) for r in got.values())
    assert all(got[i].text == t for i, t in texts.items() if i in got and t.split() == expected[i])


def test_stage_cuts_short_words_and_long_strings(spark):
    texts = corpus()
    long = " ".join("x" * 19 + str(k) for k in range(30))  # over 400 bytes in 30 words
    runless = "".join(chr(0x4E00 + (i * i + i) % 3001) for i in range(300))  # 900 bytes without white space
    texts |= {300: "one " + long, 301: "two " + long + " end", 302: runless, 303: "b " + runless, 304: ""}
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], SCHEMA)
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    expected = without_repeats({i: t for i, t in texts.items() if i < 300}, 51)
    assert {i: t.split() for i, t in got.items() if i < 300} == {i: w for i, w in expected.items() if w}
    assert long in got[300] and long not in got[301]
    assert got[302] == texts[302] and got[303].strip() == "b" and got[304] == ""

from __future__ import annotations

import random
import re
from collections import defaultdict

from tidemark.llm import line_rules

SCHEMA = "doc_id long, text string, source string, words string, line string, row string, host string"
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in re.split(f"[{SPACES}]+", text or "") if w]


def normal(line):
    return " ".join(words(re.sub("[0-9]", "0", line.lower())))


def brute(rows, more, share, left):
    holders, texts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        host, text = host or "", text or ""
        texts[host].add(text)
        for line in text.split("\n"):
            if normal(line):
                holders[host, normal(line)].add(text)
    out = []
    for doc_id, text, host in rows:
        host, text = host or "", text or ""
        w = words(text)
        grams = defaultdict(list)
        for i in range(len(w) - 4):
            grams[tuple(w[i : i + 5])].append(i)
        again = {j for g in grams.values() if len(g) > 1 for i in g for j in range(i, i + 5)}
        full = [x for x in text.split("\n") if words(x)]
        gone = sum(
            len(normal(x).split(" ")) for x in text.split("\n")
            if normal(x) and len(holders[host, normal(x)]) > more and len(holders[host, normal(x)]) > share * len(texts[host])
        )
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        depleted = len(w) - gone < len(w) * left
        out.append((doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)),
                    len(again), failed, not failed and not depleted, gone, depleted))
    return out


def check(spark, rows, more=2, share=0.05, left=0.5):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    got = line_rules.apply_rules(df, more, share, left).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, more, share, left), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "Bb", "c1", "c2", "<d>", "#", "é", "x\x0by", "z z"]
    common = ["All rights reserved 2020", "All  RIGHTS reserved 2021 ", "menu"]
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(rng.randint(0, 6))]
        lines += rng.sample(common, rng.randint(0, 2))
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["h", "i", None])))
    check(spark, rows + rows[:7])


def test_edges(spark):
    long = "one two three four five " * 4000
    rows = [(None, None, None), (1, "", "h"), (2, " \n\t", "h"), (3, "a b c d", "h"), (4, "a b c d e", "h"),
            (5, "a a a a a a a a a a a", "h"), (6, long, "h"), (7, "w" * 100_000, "h"), (7, "w" * 100_000, "h"),
            (8, " ".join(f"w{i}" for i in range(20_000)), "h")]
    check(spark, rows)


def test_exact_copies_deplete_nothing_but_shared_lines_do(spark):
    text = "\n".join(f"{c} word word{i} and more of it" for i, c in enumerate("abcdefghij"))
    copies = [(i, text, "h") for i in range(50)]
    shared = [(100 + i, f"footer of the host goes on and on for ever and ever\n{i} words", "k") for i in range(9)]
    check(spark, copies + shared)
    df = spark.createDataFrame(copies + shared, "doc_id long, text string, source string")
    kept = {r.doc_id for r in line_rules.apply_rules(df, 2).filter("kept").collect()}
    assert kept == set(range(50))


def test_empty(spark):
    assert line_rules.apply_rules(spark.createDataFrame([], SCHEMA)).collect() == []

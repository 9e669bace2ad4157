from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.model import ConfigError, Rule
from tidemark.operators import quality

SCHEMA = "id int, k string, v int, q int"


def sample(seed, n=120):
    """Rows in which a third of the keys is one value and some are null."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.choice(["hot", "hot", None, f"k{rng.randrange(n // 2)}", f"S{rng.randrange(9)}"])
        out.append((i, k, rng.choice([None, *range(-3, 10)]), rng.choice([None, 1, 2])))
    return out


RULES = [
    Rule("positive", "v", "RANGE", "v > 0"),
    Rule("named", "k", "NOT_NULL"),
    Rule("lettered", "k", "REGEX", "^[a-z]"),
    Rule("single", "k", "UNIQUE"),
    Rule("pairs", "k, v", "UNIQUE"),
    Rule("other", "v", "RANGE", "v < q * 100"),
    Rule("warned", "v", "RANGE", "v < 7", "WARN"),
    Rule("warned_single", "k", "UNIQUE", "", "WARN"),
    Rule("halting", "q", "NOT_NULL", "", "FAIL_PIPELINE"),
]


def in_sequence(data, rules):
    """The rules one after another, on Python rows: (failed rule, warned rules) by id."""
    import re

    def broken(rule, row, alive):
        _, k, v, q = row
        if rule.rule_type == "NOT_NULL":
            return {"k": k, "q": q}[rule.column_name] is None
        if rule.rule_type == "REGEX":
            return k is None or not re.search(rule.expression, k)
        if rule.rule_type == "UNIQUE":
            key = {"k": lambda r: (r[1],), "k, v": lambda r: (r[1], r[2])}[rule.column_name]
            return sum(key(r) == key(row) for r in alive) > 1
        test = {"v > 0": lambda: v > 0, "v < 7": lambda: v < 7, "v < q * 100": lambda: v < q * 100}
        return v is None or (q is None and "q" in rule.expression) or not test[rule.expression]()

    alive, failed, warned = list(data), {}, {r[0]: [] for r in data}
    for rule in rules:
        bad = [r for r in alive if broken(rule, r, alive)]
        if rule.action_on_fail == "QUARANTINE":
            failed.update({r[0]: rule.rule_id for r in bad})
            alive = [r for r in alive if r not in bad]
        else:
            for r in bad:
                warned[r[0]].append(rule.rule_id)
    return sorted((r[0], failed.get(r[0]), warned[r[0]]) for r in data)


# Lookup sizes: broadcast, shuffled, shuffled beside hot keys.
PATHS = [{}, {"spark__tidemark__broadcastBytes": 0},
         {"spark__tidemark__broadcastBytes": 0, "spark__tidemark__hotRows": 5}]


@pytest.mark.parametrize("seed", range(9))
def test_single_pass_equals_rules_in_sequence(spark, scratch, conf, seed):
    conf(**PATHS[seed % 3])
    data = sample(seed)
    rules = random.Random(seed).sample(RULES, len(RULES))
    df = spark.createDataFrame(data, SCHEMA)
    tagged = quality.tag_violations(df, rules, scratch)
    got = sorted((r["id"], r["failed_rule"], r["warned_rules"]) for r in tagged.collect())
    expected = in_sequence(data, rules)
    assert got == expected

    clean = quality.clean_rows(tagged)
    held = quality.quarantine_rows(tagged, "run")
    assert clean.columns == df.columns
    assert rows(clean.unionByName(held.select(*df.columns))) == sorted(map(tuple, data), key=repr)

    outcome = {r["rule_id"]: r for r in quality.rule_outcomes(tagged, rules).collect()}
    for rule in rules:
        n = sum(f == rule.rule_id or rule.rule_id in w for _, f, w in expected)
        status = quality.FAILED_STATUS[rule.action_on_fail] if n else "PASSED"
        assert outcome[rule.rule_id]["failed_records"] == n
        assert outcome[rule.rule_id]["status"] == status


@pytest.mark.parametrize("path", PATHS)
def test_independent_rules(spark, scratch, conf, path):
    conf(**path)
    data = sample(1)
    df = spark.createDataFrame(data, SCHEMA)
    rules = [Rule("big", "v", "EXPRESSION", "v > 2"), Rule("single", "k", "UNIQUE")]
    keys = [r[1] for r in data]
    expected = [(r[0], "big") for r in data if r[2] is None or r[2] <= 2]
    expected += [(r[0], "single") for r in data if keys.count(r[1]) > 1]
    every = quality.all_failures(df, rules, scratch).select("id", "failed_rule")
    assert rows(every) == sorted(expected, key=repr)
    clean = quality.independent_clean(df, rules, scratch).select("id")
    assert rows(clean) == sorted(((r[0],) for r in data if r[0] not in dict(expected)), key=repr)


def test_null_through_another_column_fails_once(spark, scratch):
    df = spark.createDataFrame([(1, "a", 1, None), (2, None, None, 1), (3, "b", 5, 1)], SCHEMA)
    rules = [Rule("r", "k", "RANGE", "v < q * 10"), Rule("t", "k", "RANGE", "true")]
    tagged = quality.tag_violations(df, rules, scratch)
    assert rows(tagged.select("id", "failed_rule")) == [(1, "r"), (2, "r"), (3, None)]


def test_regex_backslash_and_find(spark, scratch):
    df = spark.createDataFrame([(1, "S001"), (2, "Sdd"), (3, "xS1"), (4, None)], "id int, k string")
    tagged = quality.tag_violations(df, [Rule("r", "k", "REGEX", r"^S\d+$")], scratch)
    assert rows(tagged.filter("failed_rule IS NULL").select("id")) == [(1,)]
    tagged = quality.tag_violations(df, [Rule("r", "k", "REGEX", "S")], scratch)
    assert rows(tagged.filter("failed_rule IS NULL").select("id")) == [(1,), (2,), (3,)]


def test_no_rules_and_no_rows(spark, scratch):
    df = spark.createDataFrame(sample(2, 5), SCHEMA)
    assert rows(quality.clean_rows(quality.tag_violations(df, [], scratch))) == rows(df)
    empty = quality.tag_violations(df.limit(0), RULES, scratch)
    assert empty.count() == 0
    metrics = quality.quality_metrics(empty).first()
    assert tuple(metrics) == (0, 0, 0, 0)


def test_unique_without_repeats_adds_no_join(spark, scratch):
    df = spark.range(50).withColumn("v", F.col("id"))
    tagged = quality.tag_violations(df, [Rule("u", "id", "UNIQUE")], scratch)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Window" not in plan
    assert tagged.filter("failed_rule IS NOT NULL").count() == 0


def test_rules_are_checked_when_declared():
    assert Rule("r", "c", "range", "c > 0", "quarantine").rule_type == "RANGE"
    for bad in (("r", "c", "FANCY"), ("r", "c", "NOT_NULL", "", "IGNORE"), ("r", "c", "REGEX")):
        with pytest.raises(ConfigError):
            Rule(*bad)

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import upsert
from tidemark.operators.keys import dedup_latest
from tidemark.operators.skew import hot_key_hashes, lookup_join
from tests.test_quality import PATHS

SCHEMA = "k string, j int, ts int, v string"
KEYS = ["k", "j"]


def target_rows(seed):
    """A hot key, null keys, plain keys; some repeated."""
    rng = random.Random(seed)
    some = [("hot", 1), (None, 1), (None, None), ("a", None)] + [(f"k{i}", i % 3) for i in range(40)]
    return [(*rng.choice(some[:4] if i % 3 == 0 else some), rng.randrange(9), f"t{i}") for i in range(150)]


def source_rows(seed):
    rng = random.Random(seed + 100)
    keys = [("hot", 1), (None, 1), ("a", None)] + [(f"k{i}", i % 3) for i in range(20, 60)]
    return [(*k, rng.randrange(9), f"s{i}") for i, k in enumerate(keys) if rng.random() < 0.8]


def merged(target, source, newer=False):
    by_key = {(r[0], r[1]): r for r in source if None not in r[:2]}
    held = {(r[0], r[1]) for r in target}
    out = []
    for r in target:
        new = by_key.get((r[0], r[1])) if None not in r[:2] else None
        out.append(new if new is not None and (not newer or new[2] >= r[2]) else r)
    return sorted(out + [s for s in source if None in s[:2] or (s[0], s[1]) not in held], key=repr)


@pytest.mark.parametrize("newer", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_merge_equals_row_by_row(spark, scratch, conf, seed, newer):
    conf(**PATHS[seed % 3])
    t, s = target_rows(seed), source_rows(seed)
    target, source = spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA)
    options = {"newer_than": "ts"} if newer else {}
    got = upsert.merge_upsert(target, source, KEYS, scratch, **options)
    assert rows(got) == merged(t, s, newer)
    counts = upsert.classify_changes(target, source, KEYS).first()
    held = {r[:2] for r in t if None not in r[:2]}
    updated = sum(r[:2] in held for r in s)
    assert tuple(counts) == (len(s), len(s) - updated, updated)


def test_merge_is_idempotent_for_real_keys(spark, scratch):
    t = [r for r in target_rows(3) if None not in r[:2]]
    s = [r for r in source_rows(3) if None not in r[:2]]
    target = dedup_latest(spark.createDataFrame(t, SCHEMA), KEYS, ["ts"])
    source = spark.createDataFrame(s, SCHEMA)
    once = scratch.table(upsert.merge_upsert(target, source, KEYS, scratch))
    assert rows(upsert.merge_upsert(once, source, KEYS, scratch)) == rows(once)


def test_repeated_source_keys(spark, scratch):
    target = spark.createDataFrame([("a", 1, 1, "old")], SCHEMA)
    both = [("a", 1, 2, "x"), ("a", 1, 3, "y"), ("n", 1, 1, "n1"), ("n", 1, 2, "n2")]
    source = spark.createDataFrame(both, SCHEMA)
    with pytest.raises(upsert.RepeatedKeys):
        upsert.merge_upsert(target, source, KEYS, scratch)
    new_only = source.filter("k = 'n'")
    assert upsert.merge_upsert(target, new_only, KEYS, scratch).count() == 3
    with pytest.raises(upsert.RepeatedKeys):
        upsert.merge_upsert(target, new_only, KEYS, scratch, on_duplicate="error")
    got = upsert.merge_upsert(
        target, source, KEYS, scratch, on_duplicate="latest", latest_by=["ts"]
    )
    assert rows(got) == [("a", 1, 3, "y"), ("n", 1, 2, "n2")]
    nulls = spark.createDataFrame([(None, 1, 1, "x")], SCHEMA)
    with pytest.raises(ValueError, match="null"):
        upsert.merge_upsert(target, nulls, KEYS, scratch, null_keys="reject")


def test_dedup_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 1, 2, "z"), (None, 1, 1, "n"), (None, 1, None, "m")],
        SCHEMA,
    )
    assert rows(dedup_latest(df, KEYS, ["ts"])) == [("a", 1, 2, "z"), (None, 1, 1, "n")]
    plan = dedup_latest(df, KEYS, ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan  # one candidate per key before the shuffle


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("hot", [5, 10**9])
def test_lookup_join_with_hot_keys(spark, conf, how, null_safe, hot):
    conf(spark__tidemark__hotRows=hot)
    keys = ["h", "h", None, "a", "b", "zz"]
    big = spark.createDataFrame([(keys[i % 6], i) for i in range(120)], "k string, i int")
    look = spark.createDataFrame([("h", "H"), (None, "N"), ("a", "A"), ("q", "Q")], "k string, x string")
    assert bool(hot_key_hashes(big, ["k"])) == (hot == 5)
    values = {"h": "H", None: "N" if null_safe else None, "a": "A"}
    hit = {k for k in values if null_safe or k is not None}
    data = [(keys[i % 6], i) for i in range(120)]
    expected = {
        "left": [(k, i, values.get(k)) for k, i in data],
        "inner": [(k, i, values[k]) for k, i in data if k in hit],
        "left_semi": [r for r in data if r[0] in hit],
        "left_anti": [r for r in data if r[0] not in hit],
    }[how]
    got = lookup_join(big, look, ["k"], how, null_safe=null_safe)
    assert rows(got) == sorted(expected, key=repr)


def test_lookup_join_refuses_mixed_key_types(spark):
    left, right = spark.range(3), spark.range(3).withColumn("id", F.col("id").cast("int"))
    with pytest.raises(TypeError):
        lookup_join(left, right, ["id"])


def test_update_where(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "i int, s string")
    got = upsert.update_where(df, "i >= 2", {"s": F.lit("x"), "i": F.col("i") * 10})
    assert rows(got) == [(1, "a"), (20, "x"), (None, "c")]

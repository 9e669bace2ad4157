"""Levels, cycles and ancestors against walks of small graphs."""

from __future__ import annotations

import random

import pytest

from tests.conftest import rows
from tidemark.operators import graphs

DEPS = "pipeline_id string, parent_pipeline_id string, is_active boolean"


def frame(spark, edges, active=True):
    return spark.createDataFrame([(a, b, active) for a, b in edges], DEPS)


def reached(edges, start):
    seen, todo = set(), [start]
    while todo:
        for a, b in edges:
            if a == todo[-1] and b not in seen:
                seen.add(b)
                todo.insert(0, b)
        todo.pop()
    return seen


def expected(edges):
    nodes = {x for e in edges for x in e}
    above = {n: reached(edges, n) for n in nodes}
    cyclic = {n for n in nodes if n in above[n]}
    level = {}

    def of(n):
        if n not in level:
            level[n] = 1 + max((of(p) for c, p in edges if c == n), default=-1)
        return level[n]

    levels = {(n, None if n in cyclic or above[n] & cyclic else of(n)) for n in nodes}
    cycles = {(n, min(x for x in cyclic if x == n or (x in above[n] and n in above[x]))) for n in cyclic}
    return levels, cycles


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"p{k}" for k in range(12)]
    edges = {(rng.choice(names), rng.choice(names)) for _ in range(rng.choice([8, 14, 18]))}
    levels, cycles = expected(edges)
    found = frame(spark, [*edges, *edges])
    assert {tuple(r) for r in graphs.dependency_levels(found).collect()} == levels
    assert {tuple(r) for r in graphs.dependency_cycles(found).collect()} == cycles


def test_odd_edges(spark):
    edges = [("a", "b"), ("b", "c"), (None, "a"), ("c", None)]
    deps = frame(spark, edges).union(frame(spark, [("c", "a")], False)).union(frame(spark, [("x", "y")], None))
    assert rows(graphs.dependency_levels(deps)) == [("a", 2), ("b", 1), ("c", 0)]
    assert rows(graphs.dependency_cycles(deps)) == []
    assert rows(graphs.dependency_levels(deps.filter("false"))) == []
    assert rows(graphs.dependency_cycles(frame(spark, [("s", "s")]))) == [("s", "s")]


def test_ancestors(spark):
    parents = [("g1", "s1"), ("g1", "s2"), ("s1", "b1"), ("s2", "b1"), ("s2", "b2"), ("g2", "s3"), ("b1", "g1"), (None, "b1"), ("b2", None)]
    table = spark.createDataFrame(parents, "run_id string, parent_run_id string")
    start = spark.createDataFrame([("g1",), (None,), ("g1",)], "run_id string")
    assert rows(graphs.ancestors(table, start)) == [("b1", 2), ("b2", 2), ("g1", 0), ("s1", 1), ("s2", 1)]
    assert rows(graphs.ancestors(table, start.filter("false"))) == []

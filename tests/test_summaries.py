"""Summaries by increments and by changes, against the same aggregates over all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_whole_runs import NOW, SCHEMA, setup
from tidemark.model import ConfigError
from tidemark.operators.summary import Measure
from tidemark.plans.layers import rollup
from tidemark.plans.load import write_table
from tidemark.plans.runner import LoadOptions, run_incremental
from tidemark.plans.summaries import Summary, step_profiles
from tidemark.sources import storage
from tidemark.sources.tables import VersionedTable

KGV = "k long, g string, v int"
EXACT = [Measure("n", "count"), Measure("nv", "count", "v"), Measure("total", "sum", "v"), Measure("mean", "avg", "v")]
ALL = [*EXACT, Measure("low", "min", "v"), Measure("high", "max", "v"), Measure("kinds", "distinct", "v"), Measure("mid", "quantile", "v")]


def whole(data, full=True):
    """Expected summary of rows (k, g, v)."""
    out = []
    for g in {r[1] for r in data}:
        vs = sorted(r[2] for r in data if r[1] == g and r[2] is not None)
        row = (g, sum(r[1] == g for r in data), len(vs), sum(vs) if vs else None, sum(vs) / len(vs) if vs else None)
        out.append(row + ((vs[0], vs[-1], len(set(vs))) if vs else (None, None, 0)) if full else row)
    return sorted(out, key=repr)


def got(summary):
    return rows(summary.read().drop("mid"))


def some(rng, n, first=0):
    return [(first + k, rng.choice(["a", "b", None, "c d"]), rng.choice([None, *range(30)])) for k in range(n)]


def test_increments_add_up(spark, tmp_path):
    rng = random.Random(1)
    summary = Summary(spark, f"{tmp_path}/s", ["g"], ALL)
    parts = [some(rng, n, 1000 * k) for k, n in enumerate((40, 1, 25))]
    for k, part in enumerate(parts):
        summary.add(spark.createDataFrame(part, KGV), f"b{k}")
    parts[1] = some(rng, 30, 5000)
    summary.add(spark.createDataFrame(parts[1], KGV), "b1")  # again: replaces what it added
    summary.add(spark.createDataFrame([], KGV), "nothing")
    data = sum(parts, [])
    assert got(summary) == whole(data)
    for r in summary.read().collect():
        vs = [x[2] for x in data if x[1] == r.g and x[2] is not None]
        assert sum(v < r.mid for v in vs) <= 0.55 * len(vs) and sum(v <= r.mid for v in vs) >= 0.45 * len(vs)
    summary.fold()
    assert got(summary) == whole(data) and summary.table.read().count() == 4
    summary.add(spark.createDataFrame([(9, "new", 7)], KGV), "b9")
    assert got(summary) == whole([*data, (9, "new", 7)])
    by_nothing = summary.read_by([]).first()
    assert (by_nothing.n, by_nothing.total) == (len(data) + 1, sum(r[2] or 0 for r in data) + 7)


@pytest.mark.parametrize("measures", [EXACT, ALL])
def test_following_the_changes_of_a_table(spark, tmp_path, measures):
    """Rows that are updated, move between groups, empty a group and fill a new one."""
    rng = random.Random(2)
    layout = {"merge_keys": ["k"], "partition_cols": ["bucket(4)"]}
    data = {r[0]: r for r in some(rng, 60)}
    base = write_table(spark.createDataFrame(list(data.values()), KGV), f"{tmp_path}/t", "merge", batch_id="a", **layout)
    summary = Summary(spark, f"{tmp_path}/s", ["g"], measures)
    summary.refresh(base)
    changes = [
        [(k, "b", 100 + k) for k in range(5)] + [(70, "z", 1)],
        [(k, "a" if r[1] == "c d" else r[1], r[2]) for k, r in data.items() if r[1] in ("c d", None)],
        [(70, "b", None), (71, "z", 5), (None, "z", 6)],
    ]
    for n, change in enumerate(changes):
        write_table(spark.createDataFrame(change, KGV), base.path, "merge", batch_id=f"m{n}", changes=True, **layout)
        data |= {r[0] if r[0] is not None else "null": r for r in change}
        if n != 1:  # two changes at once the second time
            summary.refresh(base)
            summary.refresh(base)  # nothing new
            assert got(summary) == whole(list(data.values()), measures is ALL)
    assert (summary.up_to, base.last_change) == (3, 3)
    summary.fold()
    assert got(summary) == whole(list(data.values()), measures is ALL) and summary.up_to == 3
    base.forget_changes(3)
    assert base.last_change == 3 and len(storage.glob(spark, f"{base.path}/_changes/*")) == 1


def test_change_rows(spark, tmp_path):
    layout = {"merge_keys": ["k"], "partition_cols": ["g"]}
    first = [(1, "a", 1), (2, "a", 2), (3, None, 3), (4, "b", 4)]
    write_table(spark.createDataFrame(first, KGV), f"{tmp_path}/t", "merge", batch_id="a", **layout)
    source = [(1, "a", 1), (2, "b", 9), (3, None, 0), (5, "c", 5)]  # same, moved, older, new
    table = write_table(
        spark.createDataFrame(source, KGV), f"{tmp_path}/t", "merge", batch_id="b", changes=True, newer_than="v", **layout
    )
    found = {tuple(None if x is None else tuple(x) for x in r[:2]) for r in table.changes().collect()}
    assert found == {((2, "a", 2), (2, "b", 9)), (None, (5, "c", 5))}
    assert (table.written.inserted, table.written.updated, table.written.skipped) == (1, 2, 1)
    assert table.changes(after=1).count() == 0 and table.changes().first().change == 1
    plain = write_table(spark.createDataFrame(source, KGV), f"{tmp_path}/p", "merge", batch_id="b", merge_keys=["k"])
    with pytest.raises(ValueError, match="buckets"):
        write_table(spark.createDataFrame(source, KGV), plain.path, "merge", batch_id="c", merge_keys=["k"], changes=True)


def test_changes_are_there_if_and_only_if_the_merge_is(spark, tmp_path, monkeypatch):
    from tidemark.sources import tables

    layout = {"merge_keys": ["k"], "partition_cols": ["bucket(3)"]}
    base = write_table(spark.createDataFrame([(k, "a", 1) for k in range(9)], KGV), f"{tmp_path}/t", "merge", batch_id="a", **layout)
    summary = Summary(spark, f"{tmp_path}/s", ["g"], EXACT)
    summary.refresh(base)
    expected = {k: "a" for k in range(9)}
    for at in range(6):
        source = [(at, "b", 1), (50 + at, "c", 1)]
        with monkeypatch.context() as m:
            calls, move = [], tables.storage.move

            def failing(*a, calls=calls, move=move, at=at):
                calls.append(a)
                if len(calls) > at:
                    raise OSError("lost")
                return move(*a)

            m.setattr(tables.storage, "move", failing)
            try:
                write_table(spark.createDataFrame(source, KGV), base.path, "merge", batch_id=f"m{at}", changes=True, **layout)
            except OSError:
                pass
        write_table(spark.createDataFrame(source, KGV), base.path, "merge", batch_id=f"m{at}", changes=True, **layout)
        expected |= {k: g for k, g, _ in source}
        summary.refresh(base)
        assert {r.g: r.n for r in summary.read().collect()} == {g: list(expected.values()).count(g) for g in set(expected.values())}


def test_runs_that_append_states(spark, tmp_path):
    """A configured run whose target is a summary: the second run adds to the first, repeated runs do not."""
    store = setup(spark, tmp_path)
    summary = Summary(spark, f"{tmp_path}/target", ["day"], [Measure("n", "count"), Measure("total", "sum", "v")],
                      lambda df: df.withColumn("day", F.substring("t", 1, 10)))
    for n, batch in enumerate(([(1, "2024-01-01T01:00:00", 10.0)], [(2, "2024-01-01T05:00:00", 5.0), (3, "2024-01-02T01:00:00", 1.0)])):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").json(f"{tmp_path}/land/p")
        run_incremental(spark, store, "p", now=NOW, watermark_col="t", options=LoadOptions(schema=SCHEMA, transform=summary_states(summary)))
    assert rows(summary.read()) == [("2024-01-01", 2, 15.0), ("2024-01-02", 1, 1.0)]


def summary_states(summary):
    """Partials, with the newest event time of the group, which moves the watermark on."""

    def states(df):
        days = df.groupBy(F.substring("t", 1, 10).alias("day")).agg(F.max("t").alias("t"))
        return summary.partials(df).join(days, "day")

    return states


@pytest.mark.parametrize("mode", ["merge", "append"])
def test_rollups_of_increments_are_refused(spark, tmp_path, mode):
    store = setup(spark, tmp_path, mode=mode)
    with pytest.raises(ConfigError, match="rollup"):
        run_incremental(spark, store, "p", now=NOW, options=LoadOptions(transform=rollup(["k"], {"n": "count(*)"})))


def test_step_profiles(spark, tmp_path):
    profiles = step_profiles(spark, f"{tmp_path}/s")
    steps = spark.range(2000).selectExpr(
        "if(id % 2 = 0, 'a', 'b') step_name", "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 5)) start_time",
        "if(id % 7 = 0, 'FAILED', 'SUCCESS') status", "int(id) spent",
    ).withColumn("end_time", F.expr("start_time + make_interval(0, 0, 0, 0, 0, 0, spent)"))
    for part in (0, 1):
        profiles.add(steps.filter(f"spent % 2 = {part}"), f"d{part}")
    found = {r.step_name: r for r in profiles.read_by(["step_name"]).collect()}
    assert [(found[s].n_steps, found[s].max_seconds, found[s].total_seconds) for s in "ab"] == [(1000, 1998, 999_000), (1000, 1999, 1_000_000)]
    for s in "ab":
        assert abs(found[s].p50 - 1000) <= 40 and abs(found[s].p95 - 1900) <= 40
    assert profiles.read().count() == 10


def test_measures(spark, tmp_path):
    with pytest.raises(ValueError):
        Measure("x", "median")
    with pytest.raises(ValueError):
        Summary(spark, f"{tmp_path}/s", [], EXACT)
    assert VersionedTable(spark, f"{tmp_path}/s").exists() is False

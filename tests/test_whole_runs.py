"""Runs that must not lose, repeat or alter rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import parse_time
from tidemark.model import ConfigError, WatermarkState
from tidemark.plans import runner
from tidemark.plans.control import ControlStore
from tidemark.plans.load import write_table
from tidemark.plans.runner import Discrepancy, LoadOptions, run_incremental
from tidemark.schemas import FAILED_RULE
from tidemark.sources import storage, tables
from tidemark.sources.tables import VersionedTable
from tidemark.streaming.ingest import ingest_available

NOW = datetime(2024, 2, 1)
SCHEMA = "k long, t string, v double"


def setup(spark, root, pipelines=("p",), mode="append", fmt="json", rules=(), columns=()):
    store = ControlStore(spark, f"{root}/store")
    store.initialize()
    store.replace("pipeline_config", [
        {"pipeline_id": p, "pipeline_name": p, "is_active": True, "created_at": NOW} for p in pipelines])
    both = []
    for p in pipelines:
        both += [
            {"table_id": f"{p}_src", "pipeline_id": p, "layer": "landing", "table_name": "s",
             "storage_path": f"{root}/land/{p}", "file_format": fmt, "write_mode": "append"},
            {"table_id": f"{p}_tgt", "pipeline_id": p, "layer": "bronze", "table_name": "t",
             "storage_path": f"{root}/target", "file_format": "table", "write_mode": mode, "merge_keys": ["k"]},
        ]
    store.replace("table_config", both)
    if rules:
        store.replace("dq_rules", list(rules))
    if columns:
        store.replace("column_config", list(columns))
    return store


def land(spark, root, pipeline, *rows, mode="append"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).json(f"{root}/land/{pipeline}")


def run(spark, store, pipeline="p", **options):
    return run_incremental(spark, store, pipeline, now=NOW, watermark_col="t", options=LoadOptions(schema=SCHEMA, **options))


def keys(spark, root):
    return sorted(r.k for r in VersionedTable(spark, f"{root}/target").read().collect())


def test_two_pipelines_append_to_one_table(spark, tmp_path):
    store = setup(spark, tmp_path, ("p", "q"))
    land(spark, tmp_path, "p", (1, "2024-01-01", 1.0), (2, "2024-01-02", 1.0))
    land(spark, tmp_path, "q", (3, "2024-01-01", 1.0))
    run(spark, store, "p")
    run(spark, store, "q")
    assert keys(spark, tmp_path) == [1, 2, 3]


def test_late_batch_after_landing_was_replaced(spark, tmp_path):
    store = setup(spark, tmp_path)
    store.put_watermark(WatermarkState("w", "p", "p_tgt", "t", datetime(2024, 1, 10), lookback_minutes=10_000))
    land(spark, tmp_path, "p", (1, "2024-01-09", 1.0))
    run(spark, store)
    land(spark, tmp_path, "p", (2, "2024-01-08", 1.0), mode="overwrite")
    run(spark, store)
    assert keys(spark, tmp_path) == [1, 2]


def test_rows_without_a_time_do_not_share_a_segment(spark, tmp_path):
    store = setup(spark, tmp_path)
    land(spark, tmp_path, "p", (1, "2024-01-09", 1.0))
    run(spark, store, transform=lambda df: df.withColumn("t", F.lit(None).cast("string")))
    assert store.watermark("p") is not None


def test_crashed_run_is_repeated_in_its_segment(spark, tmp_path, monkeypatch):
    store = setup(spark, tmp_path)
    land(spark, tmp_path, "p", (1, "2024-01-09", 1.0))
    with monkeypatch.context() as m:
        m.setattr(runner, "advance", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, store)
    assert run(spark, store).inserted == 1
    assert keys(spark, tmp_path) == [1]


def test_new_checkpoint_is_another_stream(spark, tmp_path):
    store = setup(spark, tmp_path)
    land(spark, tmp_path, "p", (1, "2024-01-01", 1.0))
    options = LoadOptions(track_new=False)
    ingest_available(spark, store, "p", schema=SCHEMA, checkpoint=f"{tmp_path}/c1", options=options)
    land(spark, tmp_path, "p", (2, "2024-01-02", 1.0), mode="overwrite")
    ingest_available(spark, store, "p", schema=SCHEMA, checkpoint=f"{tmp_path}/c2", options=options)
    assert keys(spark, tmp_path) == [1, 2]
    runs = store.read("audit_pipeline_execution").filter("status = 'SUCCESS'").collect()
    assert len({r.run_id for r in runs}) == 2


def test_a_write_that_stores_nothing_is_a_discrepancy(spark, tmp_path, monkeypatch):
    store = setup(spark, tmp_path)
    land(spark, tmp_path, "p", (1, "2024-01-01", 1.0), (2, "2024-01-02", 1.0))
    with monkeypatch.context() as m:
        m.setattr(runner, "write_table", lambda *a, **k: None)
        with pytest.raises(Discrepancy):
            run(spark, store)
    assert store.watermark("p") is None
    row = store.read("audit_data_reconciliation").first()
    assert (row.reconciliation_status, row.discrepancy_count) == ("DISCREPANCY", 2)
    assert run(spark, store).inserted == 2


def test_merge_counts_what_it_stored(spark, tmp_path):
    store = setup(spark, tmp_path, mode="merge")
    land(spark, tmp_path, "p", (1, "2024-01-05", 1.0), (2, "2024-01-05", 1.0))
    run(spark, store)
    land(spark, tmp_path, "p", (1, "2024-01-06", 2.0), (3, "2024-01-06", 2.0), (3, "2024-01-07", 3.0))
    result = run(spark, store, on_duplicate="latest", newer_than="t")
    assert (result.inserted, result.updated, result.skipped) == (1, 1, 1)
    assert keys(spark, tmp_path) == [1, 2, 3]
    assert {r.discrepancy_count for r in store.read("audit_data_reconciliation").collect()} == {0}


def test_unreadable_times_are_quarantined_and_counted(spark, tmp_path):
    store = setup(spark, tmp_path)
    land(spark, tmp_path, "p", (1, None, 1.0), (2, "soon", 1.0), (3, "2024-01-02T10:00:00Z", 1.0),
         (4, "2024-01-03T10:00", 1.0), (5, "2024-01-04T10:00:00+02:00", 1.0), (6, "2024-01-05", 1.0))
    result = run(spark, store)
    assert (result.records_read, result.inserted, result.quarantined) == (6, 4, 2)
    held = store.quarantine("p").read()
    assert sorted(r.k for r in held.collect()) == [1, 2]
    assert {r[FAILED_RULE] for r in held.collect()} == {"watermark_readable"}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    expected = {
        "2024-03-31T02:50:00": "2024-03-31 02:50:00", "2024-01-02T10:00:00Z": "2024-01-02 10:00:00",
        "2024-01-02 10:00:00.25+02:00": "2024-01-02 08:00:00.25", "2024-10-27T00:30:00Z": "2024-10-27 00:30:00",
        "2024-10-27T01:30:00Z": "2024-10-27 01:30:00", "2024-01-02 10:00": "2024-01-02 10:00:00", "x": None,
    }
    df = spark.createDataFrame([(t,) for t in expected], "t string")
    got = {r.t: r.w for r in df.select("t", parse_time(F.col("t")).cast("string").alias("w")).collect()}
    assert got == expected


def test_a_long_error_is_stored_whole(spark, tmp_path):
    store = setup(spark, tmp_path)
    land(spark, tmp_path, "p", (1, "2024-01-01", 1.0))
    text = "x" * 20_000

    def fail(df):
        raise ValueError(text)

    with pytest.raises(ValueError):
        run(spark, store, transform=fail)
    assert store.read("audit_pipeline_execution").filter("status = 'FAILED'").first().error_message == text


def test_swap_of_partitions_survives_a_crash(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = [(i, f"d{i % 4}" if i % 4 else None, 1.0) for i in range(40)]
    write_table(spark.createDataFrame(rows, "k int, p string, v double"), path, "overwrite", batch_id="a", partition_cols=["p"])
    source = spark.createDataFrame([(1, "d2", 9.0), (4, None, 9.0), (99, "d9", 9.0)], "k int, p string, v double")
    expected = {k: (p, v) for k, p, v in rows} | {1: ("d2", 9.0), 4: (None, 9.0), 99: ("d9", 9.0)}
    moves = storage.move
    for crash_at in range(5):
        with monkeypatch.context() as m:
            calls = []

            def failing(spark, a, b):
                calls.append(a)
                if len(calls) > crash_at:
                    raise OSError("lost")
                moves(spark, a, b)

            m.setattr(tables.storage, "move", failing)
            try:
                write_table(source, path, "merge", batch_id=f"m{crash_at}", merge_keys=["k"])
            except OSError:
                pass
        got = {r.k: (r.p, r.v) for r in VersionedTable(spark, path).read().collect()}
        assert got == expected
    assert not storage.glob(spark, f"{path}/v=*/_*pending*")


def test_merge_after_appends_replaces_only_what_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    for b in range(3):
        rows = [(b * 10 + i, f"d{i % 3}", 1.0) for i in range(9)]
        write_table(spark.createDataFrame(rows, "k int, p string, v double"), path, "append", batch_id=f"b{b}", partition_cols=["p"])
    table = VersionedTable(spark, path)
    others = lambda: {f for f in table.read().inputFiles() if "/p=d1/" not in f}
    before, version = others(), table.version
    write_table(spark.createDataFrame([(1, "d1", 5.0)], "k int, p string, v double"), path, "merge", batch_id="m", merge_keys=["k"])
    assert table.version == version and others() == before
    assert table.read().count() == 27 and table.read().filter("v = 5").count() == 1


def test_lossy_values_are_not_cast(spark, tmp_path):
    columns = [{"column_id": "1", "table_id": "p_tgt", "column_name": "k", "data_type": "long", "is_nullable": False, "is_primary_key": True},
               {"column_id": "2", "table_id": "p_tgt", "column_name": "t", "data_type": "string", "is_nullable": True, "is_primary_key": False}]
    store = setup(spark, tmp_path, columns=columns)
    rows = [(1.2, "2024-01-01", 1.0), (1.9, "2024-01-01", 1.0), (3.0, "2024-01-01", 1.0)]
    schema = "k double, t string, v double"
    spark.createDataFrame(rows, schema).write.json(f"{tmp_path}/land/p")
    options = LoadOptions(schema=schema, enforce_columns=True)
    result = run_incremental(spark, store, "p", now=NOW, watermark_col="t", options=options)
    assert (result.inserted, result.quarantined) == (1, 2)
    assert keys(spark, tmp_path) == [3]
    assert sorted(r.k for r in store.quarantine("p").read().collect()) == [1.2, 1.9]


def test_keys_that_repeat_after_the_cast_are_found(spark, tmp_path):
    columns = [{"column_id": "1", "table_id": "p_tgt", "column_name": "k", "data_type": "long", "is_nullable": False, "is_primary_key": True}]
    store = setup(spark, tmp_path, columns=columns)
    schema = "k string, t string, v double"
    spark.createDataFrame([("1", "2024-01-01", 1.0), ("01", "2024-01-01", 1.0), ("2", "2024-01-01", 1.0)], schema).write.json(f"{tmp_path}/land/p")
    result = run_incremental(spark, store, "p", now=NOW, watermark_col="t", options=LoadOptions(schema=schema, enforce_columns=True))
    assert (result.inserted, result.quarantined) == (1, 2)
    assert not any(c.startswith("__") for c in store.quarantine("p").read().columns)


@pytest.mark.parametrize("have, want, ok", [
    ("bigint", "double", False), ("int", "float", False), ("int", "double", True), ("smallint", "float", True),
    ("int", "bigint", True), ("bigint", "int", False), ("float", "double", True),
])
def test_only_exact_widening(spark, have, want, ok):
    df = spark.range(1).select(F.col("id").cast(have).alias("x"))
    schema = spark.range(1).select(F.col("id").cast(want).alias("x")).schema
    if ok:
        assert tables.align(df, schema).schema == schema
    else:
        with pytest.raises(ValueError):
            tables.align(df, schema)


def test_quarantine_takes_new_and_drifted_columns_without_a_rewrite(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "q"))
    table.append(spark.createDataFrame([(1, "a")], "x long, r string"), "b1", ["r"], allow_new_columns=True)
    files = set(table.read().inputFiles())
    table.append(spark.createDataFrame([(1.5, 7, "a")], "x double, y int, r string"), "b2", ["r"], allow_new_columns=True)
    assert table.version == 1 and files <= set(table.read().inputFiles())
    got = sorted((r.x, r.x_as_text, r.y, r.r) for r in table.read().collect() if r.x) + [
        (r.x, r.x_as_text, r.y, r.r) for r in table.read().collect() if r.x is None]
    assert got == [(1, None, None, "a"), (None, "1.5", 7, "a")]


def test_csv_columns_go_by_their_header(spark, tmp_path):
    columns = [{"column_id": str(i), "table_id": "p_src", "column_name": n, "data_type": d, "is_nullable": True, "is_primary_key": False}
               for i, (n, d) in enumerate([("k", "long"), ("t", "string"), ("v", "double")])]
    store = setup(spark, tmp_path, fmt="csv", columns=columns)
    spark.createDataFrame([("2024-01-01", 2.5, 7)], "t string, v double, k long").write.option("header", True).csv(f"{tmp_path}/land/p")
    options = LoadOptions(read_options={"header": "true"})
    run_incremental(spark, store, "p", now=NOW, watermark_col="t", options=options)
    row = VersionedTable(spark, f"{tmp_path}/target").read().first()
    assert (row.k, row.t, row.v) == (7, "2024-01-01", 2.5)
    with pytest.raises(ConfigError):
        run_incremental(spark, store, "p", now=NOW, watermark_col="t")


def test_rules_in_a_given_order(spark, tmp_path):
    rules = [{"rule_id": r, "table_id": "p_tgt", "column_name": "v", "rule_type": "RANGE", "expression": "v > 5",
              "action_on_fail": "QUARANTINE", "is_active": True} for r in ("a", "b")]
    for first, expected in (((), "a"), (("b",), "b")):
        root = tmp_path / expected
        store = setup(spark, root, rules=rules)
        land(spark, root, "p", (1, "2024-01-01", 1.0))
        run(spark, store, rule_order=first)
        assert store.quarantine("p").read().first()[FAILED_RULE] == expected

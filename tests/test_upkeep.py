"""Folding of the tables that runs fill, and lineage over layers."""

from __future__ import annotations

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_whole_runs import NOW, SCHEMA, land, run, setup
from tidemark.functions.times import utc_now
from tidemark.model import WatermarkState
from tidemark.plans.lineage import trace_lineage
from tidemark.plans.runner import LoadOptions, run_incremental
from tidemark.plans.upkeep import tidy
from tidemark.sources import tables
from tidemark.sources.tables import VersionedTable

KV = "k int, p string"


def age(path, days):
    """Make the segments there look old."""
    then = time.time() - days * 86400
    for folder, _, names in os.walk(path):
        for name in names:
            os.utime(f"{folder}/{name}", (then, then))


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_old_segments_are_folded_and_new_ones_left(spark, tmp_path, parts):
    table = VersionedTable(spark, f"{tmp_path}/t")
    for k in range(6):
        table.append(spark.createDataFrame([(k, "x:y"), (k, None)], KV), f"b{k}", parts)
    age(f"{tmp_path}/t", 3)
    table.append(spark.createDataFrame([(9, "z")], KV), "fresh")
    before = rows(table.read())
    assert table.fold_segments(utc_now() - timedelta(days=1)) == 5
    assert table.segment_count == 2 and "fresh" in table.segments and rows(table.read()) == before
    assert table.fold_segments(utc_now() - timedelta(days=1)) == 0
    table.append(spark.createDataFrame([(10, "z")], KV), "fresh")  # a batch that is not folded replaces itself
    assert table.read().filter("p = 'z'").count() == 1


def test_a_fold_that_was_cut_short_is_finished(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"{tmp_path}/t")
    for k in range(4):
        table.append(spark.createDataFrame([(k, "p")], KV), f"b{k}")
    before = rows(table.read())
    for name in ("delete_all", "move", "delete"):
        with monkeypatch.context() as m:
            m.setattr(tables.storage, name, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                table.fold_segments(utc_now() + timedelta(days=1))
        assert rows(table.read()) == before
        table.append(spark.createDataFrame([(0, "p")], KV), "b0")
        before = rows(table.read())


def test_stores_stay_small_beside_runs(spark, tmp_path):
    rule = {"rule_id": "low", "table_id": "p_tgt", "column_name": "v", "rule_type": "RANGE", "expression": "v < 5",
            "action_on_fail": "QUARANTINE", "is_active": True}
    store = setup(spark, tmp_path, rules=[rule])
    for k in range(3):
        land(spark, tmp_path, "p", (k, f"2024-01-0{k + 1}", 1.0), (k + 10, f"2024-01-0{k + 1}", 9.0), mode="append")
        run(spark, store)
    kept = {n: rows(store.read(n)) for n in ("audit_pipeline_execution", "data_quality_log", "watermark_control")}
    held = rows(store.quarantine("p").read())
    assert set(tidy(store).values()) == {0}  # nothing is a day old
    age(store.root, 2)
    saved = tidy(store)
    assert saved["audit_pipeline_execution"] >= 5 and saved["quarantine/p"] >= 1
    assert {n: rows(store.read(n)) for n in kept} == kept and rows(store.quarantine("p").read()) == held
    assert store.table("audit_pipeline_execution").segment_count == 1
    land(spark, tmp_path, "p", (7, "2024-01-09", 1.0), mode="append")
    assert run(spark, store).inserted == 1


def test_lineage_of_replaced_and_foreign_rows(spark, tmp_path):
    store = setup(spark, tmp_path)
    land(spark, tmp_path, "p", (1, "2024-01-01", 1.0), (2, "2024-01-02", 2.0))
    first = run(spark, store)
    more = [r.asDict() for r in store.read("table_config").collect()]
    pipeline = store.read("pipeline_config").first().asDict()
    store.append("pipeline_config", [{**pipeline, "pipeline_id": "q"}], "q")
    silver = [{**more[0], "pipeline_id": "q", "table_id": "q_src", "layer": "bronze", "storage_path": f"{tmp_path}/target", "file_format": "table"},
              {**more[0], "pipeline_id": "q", "table_id": "q_tgt", "layer": "silver", "storage_path": f"{tmp_path}/silver", "file_format": "table"}]
    store.append("table_config", silver, "q")
    store.put_watermark(WatermarkState("wq", "q", "q_tgt", "t", datetime(2024, 1, 1, 12)), NOW)
    second = run_incremental(spark, store, "q", now=NOW, watermark_col="t", options=LoadOptions(schema=SCHEMA))
    assert second.inserted == 1
    found = {r.run_id: r for r in trace_lineage(store, VersionedTable(spark, f"{tmp_path}/silver").read()).collect()}
    assert {k: (r.steps, r.pipeline_id, r.n_rows) for k, r in found.items()} == {second.run_id: (0, "q", 1), first.run_id: (1, "p", 2)}
    assert found[second.run_id].files == [] and ".json" in found[first.run_id].files[0]
    foreign = spark.createDataFrame([("unknown",), (None,)], "batch_id string")
    assert [(r.run_id, r.n_rows) for r in trace_lineage(store, foreign).collect()] == [("unknown", 0)]
    nothing = trace_lineage(store, foreign.filter(F.lit(False)))
    assert nothing.count() == 0

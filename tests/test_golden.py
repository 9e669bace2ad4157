"""The end-to-end scenario: two batches, a backfill, and a run with nothing clean in it."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from tidemark.model import QualityHalt, WatermarkState
from tidemark.operators.lineage import trace_batch
from tidemark.operators.quality import distinct_quarantine
from tidemark.operators.reports import latest_runs, run_report
from tidemark.plans.control import ControlStore
from tidemark.plans.runner import LoadOptions, run_incremental
from tidemark.sources.tables import VersionedTable
from tests.conftest import rows

PID = "sales_landing_to_bronze"
DAY = "2026-06-20T"
BATCH_1 = [
    ("S001", "Laptop", 1200.0, 1, "10:00:00"),
    ("S002", "Mouse", 25.0, 2, "10:05:00"),
    ("S003", "Monitor", 300.0, 1, "10:10:00"),
]
BATCH_2 = [
    ("S002", "Mouse", 20.0, 3, "11:00:00"),
    ("S004", "Keyboard", 75.0, 1, "11:15:00"),
    ("S004", "Duplicate Keyboard", 75.0, 1, "11:16:00"),
    ("S005", "Broken Keyboard", -10.0, 1, "11:30:00"),
]
RULES = [
    ("sales_price_range", "unit_price", "RANGE", "unit_price > 0"),
    ("sales_id_not_null", "sale_id", "NOT_NULL", ""),
    ("sales_id_regex", "sale_id", "REGEX", r"^S\d+$"),
    ("sales_id_unique", "sale_id", "UNIQUE", ""),
]


def at(text: str) -> datetime:
    return datetime.fromisoformat(DAY + text)


def land(folder, name, batch):
    folder.mkdir(parents=True, exist_ok=True)
    keys = ("sale_id", "product", "unit_price", "quantity", "last_updated_at")
    lines = [json.dumps(dict(zip(keys, (*r[:4], DAY + r[4])))) for r in batch]
    (folder / name).write_text("\n".join(lines) + "\n")


def seed(spark, tmp, rules=RULES, mode="merge", action="QUARANTINE", active=True, lookback=0):
    store = ControlStore(spark, str(tmp / "root"))
    store.initialize()
    store.replace(
        "pipeline_config",
        [
            {
                "pipeline_id": PID,
                "pipeline_name": "Sales",
                "is_active": active,
                "created_at": at("09:00:00"),
            }
        ],
    )
    common = {"pipeline_id": PID, "partition_cols": [], "merge_keys": []}
    store.replace(
        "table_config",
        [
            {
                **common,
                "table_id": "src",
                "layer": "landing",
                "table_name": "raw_sales",
                "storage_path": str(tmp / "landing"),
                "file_format": "JSON",
                "write_mode": "append",
            },
            {
                **common,
                "table_id": "tgt",
                "layer": "bronze",
                "table_name": "sales",
                "storage_path": str(tmp / "bronze"),
                "file_format": "table",
                "write_mode": mode,
                "merge_keys": ["sale_id"],
            },
        ],
    )
    store.replace(
        "dq_rules",
        [
            {
                "rule_id": r[0],
                "table_id": "tgt",
                "column_name": r[1],
                "rule_type": r[2],
                "expression": r[3],
                "action_on_fail": r[4] if len(r) > 4 else action,
                "is_active": True,
            }
            for r in rules
        ],
    )
    store.put_watermark(
        WatermarkState("w1", PID, "tgt", "last_updated_at", None, lookback), at("09:00:00")
    )
    return store


def sales(spark, tmp):
    cols = ("sale_id", "product", "unit_price", "quantity", "last_updated_at")
    return rows(VersionedTable(spark, str(tmp / "bronze")).read().select(*cols))


def full(batch):
    return [(*r[:4], DAY + r[4]) for r in batch]


def test_two_batches_backfill_and_rerun(spark, tmp_path):
    store = seed(spark, tmp_path)
    land(tmp_path / "landing", "batch_1.json", BATCH_1)
    first = run_incremental(spark, store, PID, run_id="r1")
    assert (first.records_read, first.records_clean, first.inserted, first.updated) == (3, 3, 3, 0)
    assert first.watermark == at("10:10:00")
    assert sales(spark, tmp_path) == sorted(full(BATCH_1), key=repr)

    land(tmp_path / "landing", "batch_2.json", BATCH_2)
    second = run_incremental(spark, store, PID, run_id="r2")
    assert (second.records_read, second.records_clean, second.quarantined) == (4, 1, 3)
    assert (second.inserted, second.updated) == (0, 1)
    assert second.rule_failures == {
        "sales_price_range": 1,
        "sales_id_not_null": 0,
        "sales_id_regex": 0,
        "sales_id_unique": 2,
    }
    assert store.watermark(PID).last_watermark_value == at("11:00:00")
    s1, s2, s3 = full(BATCH_1)
    assert sales(spark, tmp_path) == sorted([s1, full(BATCH_2)[0], s3], key=repr)
    held = store.quarantine(PID).read()
    assert rows(held.select("sale_id", "product", "failed_rule", "execution_id")) == [
        ("S004", "Duplicate Keyboard", "sales_id_unique", "r2"),
        ("S004", "Keyboard", "sales_id_unique", "r2"),
        ("S005", "Broken Keyboard", "sales_price_range", "r2"),
    ]

    store.set_backfill(PID, "ACTIVE", at("10:00:00"), at("10:10:00"))
    third = run_incremental(spark, store, PID, run_id="r3")
    assert (third.records_read, third.records_clean, third.inserted, third.updated) == (2, 2, 0, 2)
    state = store.watermark(PID)
    assert (state.backfill_status, state.last_watermark_value) == ("COMPLETED", at("11:00:00"))
    # a merge is not aware of age: the older row is back
    assert sales(spark, tmp_path) == sorted([s1, s2, s3], key=repr)

    executions = store.read("audit_pipeline_execution")
    assert executions.count() == 6  # an opening and a closing row each
    assert rows(latest_runs(executions).select("run_id", "status", "records_read")) == [
        ("r1", "SUCCESS", 3),
        ("r2", "SUCCESS", 4),
        ("r3", "SUCCESS", 2),
    ]
    steps = store.read("audit_pipeline_steps")
    assert steps.count() == 9
    recon = store.read("audit_data_reconciliation")
    assert rows(recon.select("run_id", "reconciliation_status")) == [
        ("r1", "RECONCILED"),
        ("r2", "RECONCILED"),
        ("r3", "RECONCILED"),
    ]
    log = store.read("data_quality_log")
    assert rows(log.groupBy("status").count()) == [("FAILED_QUARANTINED", 2), ("PASSED", 10)]
    report = run_report(latest_runs(executions), steps, recon, log)
    assert rows(report.select("run_id", "n_steps", "discrepancy_count", "n_failed_rules")) == [
        ("r1", 3, 0, 0),
        ("r2", 3, 0, 2),
        ("r3", 3, 0, 0),
    ]

    # nothing clean: the watermark stays where it was
    again = run_incremental(spark, store, PID, run_id="r4")
    assert (again.records_read, again.records_clean, again.quarantined) == (3, 0, 3)
    assert store.watermark(PID).last_watermark_value == at("11:00:00")
    held = store.quarantine(PID).read()
    assert held.count() == 6
    assert distinct_quarantine(held, ["sale_id"], "last_updated_at").count() == 3
    trace = trace_batch(VersionedTable(spark, str(tmp_path / "bronze")).read(), held, "r2")
    assert trace.count() == 3  # the landed row of r2 was overwritten by the backfill


def test_empty_increment_completes_backfill(spark, tmp_path):
    store = seed(spark, tmp_path)
    land(tmp_path / "landing", "batch_1.json", BATCH_1)
    run_incremental(spark, store, PID, run_id="r1")
    idle = run_incremental(spark, store, PID, run_id="r2")
    assert (idle.status, idle.records_read) == ("SUCCESS", 0)
    assert store.watermark(PID).last_watermark_value == at("10:10:00")
    store.set_backfill(PID, "ACTIVE", at("12:00:00"), at("13:00:00"))
    run_incremental(spark, store, PID, run_id="r3")
    assert store.watermark(PID).backfill_status == "COMPLETED"
    zero = store.read("audit_data_reconciliation").filter("source_count = 0")
    assert zero.count() == 2


def test_halt_logs_and_keeps_earlier_quarantine(spark, tmp_path):
    rules = [
        ("a_price", "unit_price", "RANGE", "unit_price > 0"),
        ("b_unique", "sale_id", "UNIQUE", "", "FAIL_PIPELINE"),
        ("c_never", "sale_id", "NOT_NULL", ""),
    ]
    store = seed(spark, tmp_path, rules)
    land(tmp_path / "landing", "batch_2.json", BATCH_2)
    with pytest.raises(QualityHalt):
        run_incremental(spark, store, PID, run_id="r1")
    log = store.read("data_quality_log").select("rule_id", "failed_records", "status")
    assert rows(log) == [("a_price", 1, "FAILED_QUARANTINED"), ("b_unique", 2, "FAILED_HALTED")]
    assert rows(store.quarantine(PID).read().select("sale_id")) == [("S005",)]
    assert not VersionedTable(spark, str(tmp_path / "bronze")).exists()
    run = latest_runs(store.read("audit_pipeline_execution")).first()
    assert run["status"] == "FAILED" and "b_unique" in run["error_message"]
    failed = store.read("audit_pipeline_steps").filter("status = 'FAILED'")
    assert rows(failed.select("step_name")) == [("dq_checks",)]


def test_warn_keeps_rows(spark, tmp_path):
    store = seed(spark, tmp_path, action="WARN", mode="append")
    land(tmp_path / "landing", "batch_2.json", BATCH_2)
    result = run_incremental(spark, store, PID, run_id="r1")
    assert (result.records_clean, result.quarantined) == (4, 0)
    assert result.rule_failures["sales_id_unique"] == 2
    assert store.read("data_quality_log").filter("status = 'FAILED_WARN'").count() == 2


def test_append_survives_a_crash_before_the_watermark(spark, tmp_path, monkeypatch):
    store = seed(spark, tmp_path, rules=[], mode="append")
    land(tmp_path / "landing", "batch_1.json", BATCH_1)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "advance_watermark", crash)
        with pytest.raises(OSError):
            run_incremental(spark, store, PID, run_id="r1")
    run_incremental(spark, store, PID, run_id="r2")  # same start: replaces what r1 appended
    assert sales(spark, tmp_path) == sorted(full(BATCH_1), key=repr)
    land(tmp_path / "landing", "batch_2.json", BATCH_2)
    run_incremental(spark, store, PID, run_id="r3")
    assert sales(spark, tmp_path) == sorted(full(BATCH_1 + BATCH_2), key=repr)


def test_lookback_rereads_and_newer_than_protects(spark, tmp_path):
    store = seed(spark, tmp_path, rules=[], lookback=120)
    land(tmp_path / "landing", "a.json", [BATCH_2[0]])
    run_incremental(spark, store, PID)
    land(tmp_path / "landing", "b.json", BATCH_1)
    result = run_incremental(
        spark, store, PID, options=LoadOptions(newer_than="last_updated_at", on_duplicate="latest")
    )
    assert result.records_read == 4  # the late rows and the row seen before
    assert store.watermark(PID).last_watermark_value == at("11:00:00")
    s1, _, s3 = full(BATCH_1)
    assert sales(spark, tmp_path) == sorted([s1, full(BATCH_2)[0], s3], key=repr)


def test_inactive_pipeline_is_skipped(spark, tmp_path):
    store = seed(spark, tmp_path, active=False)
    assert run_incremental(spark, store, PID).status == "SKIPPED"
    assert store.read("audit_pipeline_execution").count() == 0


def test_first_success_creates_state(spark, tmp_path):
    store = seed(spark, tmp_path)
    store.replace("watermark_control", [])
    land(tmp_path / "landing", "batch_1.json", BATCH_1)
    run_incremental(spark, store, PID)
    assert store.watermark(PID).last_watermark_value == at("10:10:00")
    assert run_incremental(spark, store, PID).records_read == 0

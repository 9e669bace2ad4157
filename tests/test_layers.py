from __future__ import annotations

import json
from datetime import datetime

import pytest

from tests.conftest import rows
from tests.test_golden import BATCH_1, BATCH_2, PID, at, full, land, sales, seed
from tidemark.model import ColumnSpec, ConfigError
from tidemark.operators import conformance, quality, reports
from tidemark.plans.layers import NotReady, conformed_latest, rollup, run_layers
from tidemark.plans.runner import LoadOptions, run_incremental
from tidemark.sources.tables import VersionedTable
from tidemark.streaming.ingest import ingest_available

COLUMNS = [
    ColumnSpec("sale_id", "string", False, True),
    ColumnSpec("product", "string"),
    ColumnSpec("unit_price", "double"),
    ColumnSpec("quantity", "long"),
    ColumnSpec("last_updated_at", "timestamp"),
]
LANDING = "sale_id string, product string, unit_price double, quantity long, last_updated_at string"


def add_layer(store, tmp, name, source, target, mode, parent):
    def table(layer, kind):
        return {
            "table_id": f"{name}_{kind}",
            "pipeline_id": name,
            "layer": layer,
            "table_name": layer,
            "storage_path": str(tmp / layer),
            "file_format": "table",
            "write_mode": mode,
            "merge_keys": ["sale_id"],
        }

    def rows_of(table_name):
        return [r.asDict() for r in store.read(table_name).collect()]

    config = {"pipeline_id": name, "pipeline_name": name, "is_active": True}
    config["created_at"] = datetime(2026, 1, 1)
    store.replace("pipeline_config", [*rows_of("pipeline_config"), config])
    both = [table(source, "src"), table(target, "tgt")]
    store.replace("table_config", [*rows_of("table_config"), *both])
    link = {"dependency_id": name, "pipeline_id": name, "parent_pipeline_id": parent}
    link["is_active"] = True
    store.replace("pipeline_dependencies", [*rows_of("pipeline_dependencies"), link])


def test_three_layers(spark, tmp_path):
    store = seed(spark, tmp_path, rules=[], mode="append")
    add_layer(store, tmp_path, "silver", "bronze", "silver", "merge", PID)
    add_layer(store, tmp_path, "gold", "silver", "gold", "overwrite", "silver")
    with pytest.raises(NotReady):
        run_layers(spark, store, [("silver", None)])
    land(tmp_path / "landing", "all.json", BATCH_1 + BATCH_2)
    silver = LoadOptions(transform=conformed_latest(COLUMNS, ["sale_id"], "last_updated_at"))
    measures = {"n": "count(*)", "units": "sum(quantity)"}
    gold = LoadOptions(transform=rollup(["product"], measures), track_new=False)
    done = run_layers(spark, store, [(PID, None), ("silver", silver), ("gold", gold)])
    assert [r.status for r in done] == ["SUCCESS"] * 3
    table = VersionedTable(spark, str(tmp_path / "silver")).read()
    assert rows(table.select("sale_id", "product", "last_updated_at")) == [
        ("S001", "Laptop", at("10:00:00")),
        ("S002", "Mouse", at("11:00:00")),
        ("S003", "Monitor", at("10:10:00")),
        ("S004", "Duplicate Keyboard", at("11:16:00")),
        ("S005", "Broken Keyboard", at("11:30:00")),
    ]
    # the file stamp of the first layer survives, the batch stamp is the layer's own
    assert table.filter("source_file_name LIKE '%all.json'").count() == 5
    assert {r[0] for r in table.select("batch_id").collect()} == {done[1].run_id}
    summary = VersionedTable(spark, str(tmp_path / "gold")).read()
    assert ("Mouse", 1, 3) in rows(summary.select("product", "n", "units"))


def test_stream_takes_only_new_files(spark, tmp_path):
    store = seed(spark, tmp_path, rules=[("price", "unit_price", "RANGE", "unit_price > 0")], mode="append")
    how = {"schema": LANDING, "checkpoint": str(tmp_path / "ckpt")}
    land(tmp_path / "landing", "batch_1.json", BATCH_1)
    first = ingest_available(spark, store, PID, **how)
    assert [r.records_read for r in first] == [3]
    land(tmp_path / "landing", "batch_2.json", BATCH_2)
    second = ingest_available(spark, store, PID, **how)
    assert [(r.records_read, r.quarantined) for r in second] == [(4, 1)]
    assert ingest_available(spark, store, PID, **how) == []
    assert sales(spark, tmp_path) == sorted(full(BATCH_1 + BATCH_2[:3]), key=repr)
    table = VersionedTable(spark, str(tmp_path / "bronze")).read()
    assert table.filter("source_file_name LIKE '%batch_2.json'").count() == 3
    assert store.watermark(PID).last_watermark_value == at("11:16:00")


def test_conformance(spark, scratch):
    data = [("1", "5", "x"), ("1", "y", None), (None, None, "z")]
    df = spark.createDataFrame(data, "a string, b string, extra string")
    columns = [
        ColumnSpec("a", "string", False, True),
        ColumnSpec("b", "integer"),
        ColumnSpec("c", "timestamp"),
    ]
    assert rows(conformance.conform(df, columns)) == [
        ("1", 5, None),
        ("1", None, None),
        (None, None, None),
    ]
    assert conformance.conform(df, columns, keep_extra=True).columns == ["a", "b", "c", "extra"]
    report = {(r[0], r[1]): r[2] for r in conformance.conformance_report(df, columns).collect()}
    assert report == {
        ("a", "present"): 0,
        ("a", "type"): 0,
        ("a", "castable"): 0,
        ("a", "not_null"): 1,
        ("a", "unique"): 2,
        ("b", "present"): 0,
        ("b", "type"): 3,
        ("b", "castable"): 1,
        ("c", "present"): 3,
    }
    rules = conformance.conformance_rules(columns)
    tagged = quality.tag_violations(df, rules, scratch)
    assert [r["failed_rule"] for r in tagged.orderBy("extra").collect()] == [
        "primary_key",
        "primary_key",
        "a_not_null",
    ]


@pytest.mark.parametrize("stage", [True, False])
def test_declared_columns_are_enforced(spark, tmp_path, stage):
    store = seed(spark, tmp_path, rules=[("price", "unit_price", "RANGE", "unit_price > 0")])

    def declare(table_id, *columns):
        return [
            {
                "column_id": f"{table_id}_{i}",
                "table_id": table_id,
                "column_name": c,
                "data_type": t,
                "is_nullable": c != "sale_id",
                "is_primary_key": c == "sale_id",
            }
            for i, (c, t) in enumerate(columns)
        ]

    read_as = [c.split() for c in LANDING.split(", ")]
    kept_as = [("sale_id", "string"), ("product", "string"), ("unit_price", "double"),
               ("quantity", "int"), ("last_updated_at", "timestamp_ntz")]
    store.replace("column_config", declare("src", *read_as) + declare("tgt", *kept_as))
    odd = [("S006", "Cable", 5.0, 1 << 40, "11:40:00"), (None, "Cable", 5.0, 1, "11:41:00")]
    land(tmp_path / "landing", "a.json", BATCH_1 + BATCH_2[1:] + odd)
    result = run_incremental(
        spark, store, PID, options=LoadOptions(enforce_columns=True, stage=stage)
    )
    failures = {k: n for k, n in result.rule_failures.items() if n}
    assert failures == {"quantity_castable": 1, "sale_id_not_null": 1, "primary_key": 2, "price": 1}
    assert (result.records_read, result.records_clean) == (8, 3)
    table = VersionedTable(spark, str(tmp_path / "bronze")).read()
    kinds = dict(table.dtypes)
    assert (kinds["quantity"], kinds["last_updated_at"]) == ("int", "timestamp_ntz")
    held = store.quarantine(PID).read().filter("failed_rule = 'quantity_castable'")
    assert [r["quantity"] for r in held.collect()] == [1 << 40]  # as it came


def test_store_lookups(spark, tmp_path):
    store = seed(spark, tmp_path)
    assert store.pipeline(PID).pipeline_name == "Sales"
    assert [r.rule_id for r in store.rules(PID)] == sorted(r.rule_id for r in store.rules(PID))
    assert store.rules("other") == []
    with pytest.raises(ConfigError, match="not found"):
        store.pipeline("other")
    with pytest.raises(ConfigError, match="lacks"):
        store.source_and_target("other")
    assert not store.advance_watermark("other", at("10:00:00"))
    assert not store.set_backfill("other", "ACTIVE")
    assert store.watermark("other") is None
    store.update("pipeline_config", f"pipeline_id = '{PID}'", {"is_active": reports.F.lit(False)})
    assert not store.pipeline(PID).is_active
    store.set_backfill(PID, "ACTIVE", at("10:00:00"), at("11:00:00"), now=at("09:00:00"))
    store.set_backfill(PID, "COMPLETED", now=at("09:00:00"))  # same clock, later state
    state = store.watermark(PID)
    assert (state.backfill_status, state.backfill_start) == ("COMPLETED", at("10:00:00"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_survive_another_session_zone(spark, tmp_path, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    store = seed(spark, tmp_path)
    store.advance_watermark(PID, at("10:05:00"))
    assert store.watermark(PID).last_watermark_value == at("10:05:00")
    land(tmp_path / "landing", "batch_1.json", BATCH_1)
    result = run_incremental(spark, store, PID)
    assert (result.records_read, result.watermark) == (1, at("10:10:00"))
    assert store.watermark(PID).last_watermark_value == at("10:10:00")


def test_required_control_values(spark, tmp_path):
    store = seed(spark, tmp_path)
    with pytest.raises(Exception, match="(?i)null"):
        store.replace("pipeline_config", [{"pipeline_id": "x"}])
    assert store.pipeline(PID).pipeline_id == PID


def test_dependency_readiness(spark):
    deps = spark.createDataFrame(
        [("g", "a", True), ("g", "b", True), ("h", "a", True), ("h", "b", False), ("i", "c", True)],
        "pipeline_id string, parent_pipeline_id string, is_active boolean",
    )
    runs = spark.createDataFrame(
        [
            ("1", "a", at("10:00:00"), "FAILED"),
            ("2", "a", at("11:00:00"), "SUCCESS"),
            ("3", "b", at("10:00:00"), "SUCCESS"),
            ("4", "b", at("11:00:00"), "RUNNING"),
        ],
        "run_id string, pipeline_id string, execution_start timestamp, status string",
    )
    assert rows(reports.dependency_ready(deps, runs)) == [
        ("g", False, 2, 1),
        ("h", True, 1, 0),
        ("i", False, 1, 1),
    ]


def test_landing_csv_with_header(spark, tmp_path):
    store = seed(spark, tmp_path, rules=[])
    store.update("table_config", "layer = 'landing'", {"file_format": reports.F.lit("csv")})
    folder = tmp_path / "landing"
    folder.mkdir()
    lines = ["sale_id,product,unit_price,quantity,last_updated_at"]
    lines += [",".join(map(str, r)) for r in full(BATCH_1)]
    (folder / "a.csv").write_text("\n".join(lines))
    options = LoadOptions(schema=LANDING, read_options={"header": "true"})
    assert run_incremental(spark, store, PID, options=options).records_read == 3
    assert json.dumps(sales(spark, tmp_path)) == json.dumps(full(BATCH_1))

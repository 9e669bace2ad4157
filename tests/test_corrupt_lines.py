"""Lines that do not fit their format are kept as they are."""

from __future__ import annotations

import pytest

from tests.test_whole_runs import NOW, setup
from tidemark.plans.runner import WELL_FORMED, LoadOptions, run_incremental
from tidemark.sources.files import CORRUPT, read_source
from tidemark.sources.tables import VersionedTable
from tidemark.streaming.ingest import ingest_available

SCHEMA = "k long, t string, v double"
JSON = ['{"k":1,"t":"2024-01-01","v":1.5}', '{"k":2,"t":"2024-0', "no json at all", '{"k":"text","t":"2024-01-02","v":1}', '{"k":5,"t":"2024-01-03"}']
CSV = ["k,t,v", "1,2024-01-01,1.5", "2,2024-01-02", "x,2024-01-02,2.0", "5,2024-01-03,2.5", "6,2024-01-03,2.5,extra"]


def land(tmp_path, name, lines):
    folder = tmp_path / "land" / "p"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize(
    "fmt,lines,loaded,held,options",
    [("json", JSON, [1, 5], JSON[1:4], {}), ("csv", CSV, [1, 5], [CSV[2], CSV[3], CSV[5]], {"header": "true"})],
)
def test_held_with_their_text(spark, tmp_path, fmt, lines, loaded, held, options):
    store = setup(spark, tmp_path, fmt=fmt)
    land(tmp_path, f"a.{fmt}", lines)
    result = run_incremental(spark, store, "p", now=NOW, watermark_col="t", options=LoadOptions(schema=SCHEMA, read_options=options))
    assert (result.records_read, result.inserted, result.quarantined) == (5, len(loaded), len(held))
    target = VersionedTable(spark, f"{tmp_path}/target").read()
    assert sorted(r.k for r in target.collect()) == loaded and CORRUPT not in target.columns
    found = store.quarantine("p").read().collect()
    assert sorted(r[CORRUPT] for r in found) == sorted(held)
    assert {r.failed_rule for r in found} == {WELL_FORMED}
    assert {r.rule_id: r.failed_records for r in store.read("data_quality_log").collect()} == {WELL_FORMED: len(held)}


def test_clean_files_leave_no_trace(spark, tmp_path):
    store = setup(spark, tmp_path)
    land(tmp_path, "a.json", [JSON[0], '{"k":9,"t":null,"v":1}'])
    run_incremental(spark, store, "p", now=NOW, watermark_col="t", options=LoadOptions(schema=SCHEMA))
    assert CORRUPT not in store.quarantine("p").read().columns


def test_modes_that_drop_or_refuse(spark, tmp_path):
    land(tmp_path, "a.json", JSON)
    path = f"{tmp_path}/land/p"
    dropped = read_source(spark, path, "json", schema=SCHEMA, options={"mode": "DROPMALFORMED"}, keep_corrupt=True)
    assert CORRUPT not in dropped.columns and {r.k for r in dropped.collect()} == {1, 5}
    inferred = read_source(spark, path, "json", keep_corrupt=True)
    assert CORRUPT in inferred.columns and "_corrupt_record" not in inferred.columns


def test_streams_hold_them_too(spark, tmp_path):
    store = setup(spark, tmp_path)
    land(tmp_path, "a.json", JSON)
    results = ingest_available(spark, store, "p", schema=SCHEMA, checkpoint=f"{tmp_path}/check")
    assert [(r.inserted, r.quarantined) for r in results] == [(2, 3)]
    assert sorted(r[CORRUPT] for r in store.quarantine("p").read().collect()) == sorted(JSON[1:4])

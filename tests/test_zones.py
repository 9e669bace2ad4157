"""Runs under other zones of the process, in processes of their own."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
HEAD = """
import sys, json
from datetime import datetime, timedelta, timezone
from pathlib import Path
from pyspark.sql import SparkSession
root = sys.argv[1]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", root + "/shared")
    .config("spark.sql.session.timeZone", sys.argv[2]).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from tests.test_whole_runs import setup
from tidemark.model import WatermarkState
from tidemark.plans.runner import LoadOptions, run_incremental
from tidemark.sources.tables import VersionedTable
def land(name, *rows):
    Path(root, "land/p").mkdir(parents=True, exist_ok=True)
    Path(root, "land/p", name).write_text("".join(json.dumps({"k": k, "t": t}) + "\\n" for k, t in rows))
def run(kind="string", **more):
    return run_incremental(spark, store, "p", watermark_col="t", options=LoadOptions(schema=f"k long, t {kind}"), **more)
def keys():
    return sorted(r.k for r in VersionedTable(spark, root + "/target").read().collect())
store = setup(spark, root)
"""


def python(code, tmp_path, zone, session="UTC"):
    env = os.environ | {"TZ": zone, "PYTHONPATH": str(ROOT)}
    script = HEAD + textwrap.dedent(code)
    done = subprocess.run([sys.executable, "-c", script, str(tmp_path), session], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return json.loads(done.stdout.strip().splitlines()[-1])


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz", "timestamp"])
def test_nothing_is_lost_at_the_hour_that_does_not_exist(tmp_path, kind):
    code = f"""
    marks, z = [], "Z" if {kind!r} == "timestamp" else ""
    for n, t in enumerate(["01:30", "02:50", "03:20", "03:40"]):
        land(f"{{n}}.json", (n, f"2024-03-31T{{t}}:00{{z}}"))
        marks.append(run({kind!r}, now=datetime(2024, 3, 31, 4)).watermark.isoformat())
        assert store.watermark("p").last_watermark_value.isoformat() == marks[-1]
    print(json.dumps([marks, keys()]))
    """
    marks, keys = python(code, tmp_path, "Europe/Berlin", "Europe/Berlin" if kind == "timestamp" else "UTC")
    assert marks == [f"2024-03-31T{t}:00" for t in ("01:30", "02:50", "03:20", "03:40")]
    assert keys == [0, 1, 2, 3]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("kind", ["string", "timestamp"])
def test_the_clock_of_a_run_is_utc(tmp_path, zone, kind):
    code = f"""
    now = datetime.now(timezone.utc)
    z = lambda d: (now + d).strftime("%Y-%m-%dT%H:%M:%SZ")
    land("a.json", (1, z(timedelta(hours=-1))), (2, z(timedelta(minutes=30))), (3, z(timedelta(hours=6))), (4, z(timedelta(hours=-30))))
    result = run({kind!r})
    row = VersionedTable(spark, root + "/target").read().selectExpr("unix_seconds(ingestion_timestamp) s").first()
    ended = store.read("audit_pipeline_execution").filter("status = 'SUCCESS'").selectExpr("unix_seconds(execution_end) s").first()
    print(json.dumps([keys(), row.s - now.timestamp(), ended.s - now.timestamp()]))
    """
    keys, loaded, ended = python(code, tmp_path, zone)
    assert keys == [1, 4] and abs(loaded) < 300 and abs(ended) < 300

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import minutes_before, parse_time, seconds_between
from tidemark.model import WatermarkState
from tidemark.operators import increment, lineage

A, B = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 12)
TIMES = [
    (1, datetime(2024, 1, 1, 10)),
    (2, datetime(2024, 1, 1, 10, 0, 1)),
    (3, datetime(2024, 1, 1, 12)),
    (4, datetime(2024, 1, 1, 12, 0, 1)),
    (5, None),
]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_window_excludes_start_and_includes_end(spark, kind):
    data = [(i, str(t) if kind == "string" and t else t) for i, t in TIMES]
    df = spark.createDataFrame(data, f"id int, ts {kind}")

    def ids(start, end):
        return [r[0] for r in rows(increment.select_increment(df, "ts", start, end).select("id"))]

    assert ids(A, B) == [2, 3]
    assert ids(A, None) == [2, 3, 4]
    assert ids(None, B) == [1, 2, 3]
    assert ids(None, None) == [1, 2, 3, 4, 5]
    assert increment.next_watermark(df, "ts").first()[0] == TIMES[3][1]
    none = df.filter("id = 5")
    assert increment.next_watermark(none, "ts", A).first()[0] == A
    assert increment.next_watermark(none, "ts").first()[0] is None
    profile = increment.window_profile(df, "ts", A, B).first()
    assert tuple(profile) == (5, 2, 1, 1, 1, 0)


def test_typed_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(TIMES, "id int, ts timestamp_ntz").write.parquet(path)
    df = increment.select_increment(spark.read.parquet(path), "ts", A, B)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_text_times(spark):
    texts = {
        "2024-01-01T10:00:00": A,
        "2024-01-01 10:00:00": A,
        "2024-01-01T10:00:00.25": datetime(2024, 1, 1, 10, 0, 0, 250000),
        "2024-01-01": datetime(2024, 1, 1),
        "2024-13-01": None,
        "yesterday": None,
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", parse_time(F.col("t"))).collect()} == texts


def test_watermark_of_mixed_text_is_not_lexicographic(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("2024-01-01 23:00:00",)], "ts string")
    assert increment.next_watermark(df, "ts").first()[0] == datetime(2024, 1, 1, 23)


def test_missing_column_loads_everything_or_fails(spark):
    df = spark.range(3)
    with pytest.warns(UserWarning, match="full load"):
        assert increment.select_increment(df, "ts", A, B).count() == 3
    with pytest.raises(ValueError):
        increment.select_increment(df, "ts", A, B, on_missing="error")
    with pytest.raises(TypeError):
        increment.select_increment(df, "id", A, B)


def test_bounds():
    state = WatermarkState("w", "p", "t", "ts", A, lookback_minutes=90)
    assert increment.resolve_bounds(None, B) == increment.Bounds(None, B)
    assert increment.resolve_bounds(state, B).start == datetime(2024, 1, 1, 8, 30)
    first = WatermarkState("w", "p", "t", "ts", None, lookback_minutes=90)
    assert increment.resolve_bounds(first, B) == increment.Bounds(None, B)
    back = WatermarkState("w", "p", "t", "ts", A, 90, "ACTIVE", A, B)
    assert increment.resolve_bounds(back, datetime(2025, 1, 1)) == increment.Bounds(A, B, True)
    done = WatermarkState("w", "p", "t", "ts", A, 0, "COMPLETED", A, B)
    assert increment.resolve_bounds(done, B) == increment.Bounds(A, B)


def test_time_arithmetic(spark):
    df = spark.createDataFrame([(A, B)], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(minutes_before(F.col("b"), 30), seconds_between(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (datetime(2024, 1, 1, 11, 30), 7200)


def test_stamps(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).coalesce(1).write.json(path)
    df = spark.read.json(path).filter("id > 0")
    one = lineage.stamp(df, "b1", A)
    got = one.select("batch_id", "ingestion_timestamp", "source_file_name").distinct().collect()
    assert len(got) == 1
    assert got[0][:2] == ("b1", A)
    assert got[0][2].startswith("file:") and got[0][2].endswith(".json")
    again = lineage.stamp(one, "b2", B, keep_file=True)
    assert again.select("source_file_name").first()[0] == got[0][2]
    assert lineage.stamp(spark.range(1), "b3").first()["batch_id"] == "b3"  # not a file scan

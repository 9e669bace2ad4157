"""Windows, sessions and first rows of streams that stop and go on."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.summary import Measure
from tidemark.streaming import windows

SCHEMA = "k string, ts timestamp_ntz, v int"
BEGIN = datetime(2024, 5, 1)


def land(spark, folder, *data):
    spark.createDataFrame([(k, BEGIN + timedelta(minutes=m), v) for k, m, v in data], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def minute(column):
    return ((F.unix_timestamp(column) - int((BEGIN - datetime(1970, 1, 1)).total_seconds())) / 60).cast("int").alias(column)


def test_windows_go_on_after_a_restart(spark, tmp_path):
    land_at, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"

    def run():
        found = windows.tumbling(stream(spark, land_at), "ts", "10 minutes", "20 minutes", ["k"], [Measure("n", "count"), Measure("s", "sum", "v")])
        table = windows.append_available(spark, found, out, checkpoint)
        return rows(table.read().select(minute("window_start"), minute("window_end"), "k", "n", "s"))

    land(spark, land_at, ("a", 1, 1), ("a", 9, 2), ("b", 3, 5), ("a", 12, 4))
    assert run() == []  # nothing is old enough
    land(spark, land_at, ("a", 5, 10), ("a", 31, 1))  # adds to a window kept in the state; closes it
    assert run() == [(0, 10, "a", 3, 13), (0, 10, "b", 1, 5)]
    assert run() == [(0, 10, "a", 3, 13), (0, 10, "b", 1, 5)]  # no new input
    land(spark, land_at, ("a", 2, 100), ("b", 70, 1))  # too late; closes the rest
    assert run() == [(0, 10, "a", 3, 13), (0, 10, "b", 1, 5), (10, 20, "a", 1, 4), (30, 40, "a", 1, 1)]


def test_sessions(spark, tmp_path):
    land_at = f"{tmp_path}/in"

    def run():
        found = windows.sessions(stream(spark, land_at), "ts", "10 minutes", "5 minutes", ["k"], [Measure("n", "count")])
        table = windows.append_available(spark, found, f"{tmp_path}/out", f"{tmp_path}/check")
        return rows(table.read().select(minute("window_start"), minute("window_end"), "k", "n"))

    land(spark, land_at, ("a", 0, 1), ("a", 9, 1), ("b", 4, 1))
    assert run() == []
    land(spark, land_at, ("a", 18, 1), ("b", 40, 1))  # the first session of a goes on
    assert run() == [(0, 28, "a", 3), (4, 14, "b", 1)]


def test_first_rows_of_keys(spark, tmp_path):
    land_at = f"{tmp_path}/in"

    def run():
        found = windows.unique_within(stream(spark, land_at), "ts", "30 minutes", ["k"]).select("k", "v")
        return rows(windows.append_available(spark, found, f"{tmp_path}/out", f"{tmp_path}/check").read())

    land(spark, land_at, ("a", 0, 1), ("b", 5, 1))
    spark.createDataFrame([("c", None, 1)], SCHEMA).write.mode("append").parquet(land_at)  # no event time
    assert run() == [("a", 1), ("b", 1)]
    land(spark, land_at, ("a", 10, 2), ("d", 20, 2))
    assert run() == [("a", 1), ("b", 1), ("d", 2)]
    land(spark, land_at, ("e", 90, 3))  # a, b and d are forgotten
    run()
    land(spark, land_at, ("a", 95, 4))
    assert run() == [("a", 1), ("a", 4), ("b", 1), ("d", 2), ("e", 3)]

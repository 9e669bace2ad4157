from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.upsert import RepeatedKeys
from tidemark.plans.load import write_table
from tidemark.sources import storage
from tidemark.sources.files import read_source
from tidemark.sources.tables import VersionedTable, align


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, p string, v double")


def test_bootstrap_takes_any_mode_as_it_is(spark, tmp_path):
    path = str(tmp_path / "t")
    doubled = frame(spark, (1, "a", 1.0), (1, "a", 2.0))
    assert not VersionedTable(spark, path).exists()
    write_table(doubled, path, "merge", batch_id="b1", merge_keys=["k"])
    assert rows(VersionedTable(spark, path).read()) == [(1, "a", 1.0), (1, "a", 2.0)]


def test_overwrite_may_read_what_it_replaces(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, (1, "a", 1.0)), "b1")
    before = table.read()
    table.overwrite(table.read().withColumn("v", F.col("v") + 1), "b2")
    assert rows(table.read()) == [(1, "a", 2.0)]
    assert rows(before) == [(1, "a", 1.0)]  # readers of the old version are not disturbed
    assert table.version == 2
    table.overwrite(frame(spark), "b3")
    assert table.read().count() == 0
    table.expire(keep=1)
    assert len(storage.glob(spark, f"{table.path}/v=*")) == 1


def test_append_replaces_its_own_batch_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(frame(spark, (1, "a", 1.0)), "run/1")
    table.append(frame(spark, (2, "b", 2.0)), "run/2")
    table.append(frame(spark, (3, "c", 3.0)), "run/2")
    assert rows(table.read()) == [(1, "a", 1.0), (3, "c", 3.0)]
    table.compact()
    assert rows(table.read()) == [(1, "a", 1.0), (3, "c", 3.0)]


def test_uncommitted_writes_are_invisible(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(frame(spark, (1, "a", 1.0)), "b1")
    torn = tmp_path / "t" / "v=00000002" / "seg=b2"
    torn.mkdir(parents=True)  # a version whose job never committed
    (tmp_path / "t" / "v=00000001" / "seg=b9").mkdir()
    assert rows(table.read()) == [(1, "a", 1.0)]
    table.overwrite(frame(spark, (2, "b", 2.0)), "b2")
    assert rows(table.read()) == [(2, "b", 2.0)]


def test_create_is_idempotent_and_empty(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    schema = frame(spark).schema
    table.create(schema)
    assert table.read().count() == 0
    table.append(frame(spark, (1, "a", 1.0)), "b1")
    table.create(schema)
    assert rows(table.read()) == [(1, "a", 1.0)]


@pytest.mark.parametrize("segments", [1, 2])
def test_replace_partitions(spark, tmp_path, segments):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, (1, "a", 1.0), (2, "b", 2.0), (4, None, 4.0)), "b1", ["p"])
    expected = [(2, "b", 2.0), (9, "a", 9.0)]
    if segments == 2:
        table.append(frame(spark, (3, "a", 3.0), (5, "c", 5.0)), "b2")
        expected.append((5, "c", 5.0))
    table.replace_partitions(frame(spark, (9, "a", 9.0), (8, None, 8.0)), "b3")
    assert rows(table.read()) == sorted([*expected, (8, None, 8.0)], key=repr)


def test_partition_values_keep_their_type(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, (1, "007", 1.0)), "2024", ["p"])
    assert rows(table.read()) == [(1, "007", 1.0)]


def test_merge_touches_only_partitions_of_the_source(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(
        frame(spark, (1, "a", 1.0), (2, "b", 2.0)), path, "merge", batch_id="b1", partition_cols=["p"]
    )
    untouched = storage.glob(spark, f"{path}/v=*/seg=*/p=b/*.parquet")
    source = frame(spark, (1, "a", 5.0), (3, "a", 3.0), (4, "c", 4.0))
    table = write_table(source, path, "merge", batch_id="b2", merge_keys=["k", "p"])
    assert rows(table.read()) == [(1, "a", 5.0), (2, "b", 2.0), (3, "a", 3.0), (4, "c", 4.0)]
    assert storage.glob(spark, f"{path}/v=*/seg=*/p=b/*.parquet") == untouched


def test_merge_moves_a_key_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(frame(spark, (1, "a", 1.0)), path, "merge", batch_id="b1", partition_cols=["p"])
    moved = frame(spark, (1, "b", 5.0))
    table = write_table(moved, path, "merge", batch_id="b2", merge_keys=["k"])
    assert rows(table.read()) == [(1, "b", 5.0)]


@pytest.mark.parametrize("newer", [False, True])
def test_merge_by_a_key_that_is_not_the_partition(spark, tmp_path, newer):
    path = str(tmp_path / "t")
    old = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0), (4, "c", 9.0), (5, "c", 5.0), (6, None, 6.0)]
    write_table(frame(spark, *old), path, "merge", batch_id="b1", partition_cols=["p"])
    untouched = storage.glob(spark, f"{path}/v=*/seg=*/p=b/*.parquet")
    source = frame(spark, (1, "d", 7.0), (4, "d", 8.0), (6, None, 7.0), (7, "e", 7.0))
    options = {"newer_than": "v"} if newer else {}
    table = write_table(source, path, "merge", batch_id="b2", merge_keys=["k"], **options)
    four = (4, "c", 9.0) if newer else (4, "d", 8.0)
    expected = [(1, "d", 7.0), (2, "a", 2.0), (3, "b", 3.0), four, (5, "c", 5.0), (6, None, 7.0)]
    assert rows(table.read()) == sorted([*expected, (7, "e", 7.0)], key=repr)
    assert table.version == 1
    assert storage.glob(spark, f"{path}/v=*/seg=*/p=b/*.parquet") == untouched


def test_refused_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    one = frame(spark, (1, "a", 1.0))
    write_table(one, path, "append", batch_id="b1")
    with pytest.raises(ValueError, match="merge keys"):
        write_table(one, path, "merge", batch_id="b2")
    with pytest.raises(ValueError, match="unsupported write mode"):
        write_table(one, path, "upsert", batch_id="b2")
    with pytest.raises(ValueError, match="no partition columns"):
        write_table(one, path, "replace_partitions", batch_id="b2")
    with pytest.raises(ValueError, match="unknown"):
        write_table(one.withColumn("x", F.lit(1)), path, "append", batch_id="b2")
    with pytest.raises(ValueError, match="table has"):
        align(one.withColumn("v", F.lit("1")), one.schema)
    twice = frame(spark, (1, "a", 1.0), (1, "a", 2.0))
    with pytest.raises(RepeatedKeys):
        write_table(twice, path, "merge", batch_id="b2", merge_keys=["k"])
    assert rows(VersionedTable(spark, path).read()) == [(1, "a", 1.0)]


def test_new_columns_on_request(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(frame(spark, (1, "a", 1.0)), "b1")
    wider = frame(spark, (2, "b", 2.0)).withColumn("x", F.lit("new"))
    table.append(wider, "b2", allow_new_columns=True)
    table.append(frame(spark, (3, "c", 3.0)), "b3", allow_new_columns=True)
    table.append(wider, "b2", allow_new_columns=True)  # again: replaces itself and nothing else
    assert rows(table.read()) == [(1, "a", 1.0, None), (2, "b", 2.0, "new"), (3, "c", 3.0, None)]


def test_a_repeated_batch_never_replaces_a_rewrite(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(frame(spark, (1, "a", 1.0)), path, "append", batch_id="b1")
    write_table(frame(spark, (2, "b", 2.0)), path, "overwrite", batch_id="b2")
    table = write_table(frame(spark, (3, "c", 3.0)), path, "append", batch_id="b2")
    assert rows(table.read()) == [(2, "b", 2.0), (3, "c", 3.0)]


def test_narrower_numbers_are_widened(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, 2.5)], "k long, v double"), "b1")
    table.append(spark.createDataFrame([(2, 3)], "v int, k int"), "b2")
    assert rows(table.read()) == [(1, 2.5), (3, 2.0)]
    with pytest.raises(ValueError, match="table has"):
        table.append(spark.createDataFrame([("3", 2.5)], "k string, v double"), "b3")


def test_file_formats(spark, tmp_path):
    one = frame(spark, (1, "a", 1.0))
    one.write.option("header", True).csv(str(tmp_path / "csv"))
    one.write.json(str(tmp_path / "json"))
    one.write.parquet(str(tmp_path / "parquet"))
    one.write.orc(str(tmp_path / "orc"))
    for kind in ("CSV", "json", "Parquet"):
        options = {"header": "true"} if kind == "CSV" else {}
        found = read_source(
            spark, str(tmp_path / kind.lower()), kind, schema=one.schema, options=options
        )
        assert rows(found.select("k", "p", "v")) == [(1, "a", 1.0)]
    with pytest.raises(ValueError, match="unsupported file format"):
        read_source(spark, str(tmp_path / "orc"), "orc")
    assert read_source(spark, str(tmp_path / "orc"), "orc", formats=None).count() == 1
    VersionedTable(spark, str(tmp_path / "t")).overwrite(one, "b1")
    assert read_source(spark, str(tmp_path / "t"), "table").count() == 1


def test_one_task_sorts_few_rows_by_folder(spark, tmp_path, monkeypatch):
    """However much there is of one folder, it is read and written in parts of bounded size."""
    from tidemark import scratch as settings

    spark.range(200_000).selectExpr("id", "'a' AS day").repartition(8).write.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(settings, "SORTED_BYTES", 64 << 10, raising=False)
    monkeypatch.setattr(settings, "SORTED_BYTES_READ", 128 << 10, raising=False)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.append(spark.read.parquet(str(tmp_path / "rows")), "one", ["day"]) == 200_000
    files = list((tmp_path / "t").glob("v=*/seg=one/day=a/*.parquet"))
    assert len(files) > 3
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before

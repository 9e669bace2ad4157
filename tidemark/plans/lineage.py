"""Lineage over all layers: from rows of any table back to the files they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.graphs import ancestors
from tidemark.operators.reports import latest_runs
from tidemark.plans.control import ControlStore
from tidemark.schemas import BATCH_ID, SOURCE_FILE
from tidemark.scratch import Scratch
from tidemark.sources.tables import VersionedTable


def trace_lineage(store: ControlStore, rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per run that ``rows`` (with their batch ids) came from, directly or through other layers, with
    ``steps`` (0: wrote the rows), its pipeline, the rows of its target that bear its id, and, of runs that
    read files, these files. Runs whose rows have since been replaced have no rows left."""
    spark = rows.sparkSession
    scratch = scratch or Scratch(spark)
    found = ancestors(store.read("audit_run_parents"), rows.select(F.col(BATCH_ID).alias("run_id")), scratch)
    runs = latest_runs(store.read("audit_pipeline_execution")).select("run_id", "pipeline_id")
    named = scratch.table(found.join(runs, "run_id", "left"))
    held = None
    for r in named.select("pipeline_id").dropna().distinct().collect():  # pipelines of one chain of layers
        source, target = store.source_and_target(r.pipeline_id)
        mine = named.filter(F.col("pipeline_id") == r.pipeline_id).select(F.col("run_id").alias(BATCH_ID))
        landed = VersionedTable(spark, target.storage_path).read().join(mine, BATCH_ID, "left_semi")
        reads_files = F.lit(source.file_format.lower() != "table")
        counted = landed.groupBy(F.col(BATCH_ID).alias("run_id")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.collect_set(F.when(reads_files, F.col(SOURCE_FILE))).alias("files")
        )
        held = counted if held is None else held.unionByName(counted)
    if held is None:
        empty = F.array().cast("array<string>")
        return named.withColumns({"n_rows": F.lit(0).cast("long"), "files": empty})
    joined = named.join(held, "run_id", "left")
    return joined.withColumns({"n_rows": F.coalesce("n_rows", F.lit(0).cast("long")), "files": F.sort_array("files")})

"""Layer transforms and the ordered run of dependent pipelines."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import ColumnSpec
from tidemark.operators.conformance import conform
from tidemark.operators.keys import dedup_latest
from tidemark.operators.reports import dependency_ready, latest_runs
from tidemark.plans.control import ControlStore
from tidemark.plans.runner import LoadOptions, RunResult, run_incremental


class NotReady(RuntimeError):
    """A parent pipeline has not succeeded yet."""


def conformed_latest(
    columns: Sequence[ColumnSpec], keys: list[str], latest_by: str
) -> Callable[[DataFrame], DataFrame]:
    """Transform to a conformed layer: declared types, one latest row per key."""

    def apply(df: DataFrame) -> DataFrame:
        return dedup_latest(conform(df, columns, keep_extra=True), keys, [latest_by])

    return apply


def rollup(group_by: list[str], measures: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """Transform to a summary layer that is computed from all rows each time: SQL aggregate expressions by
    alias. ``summaries.Summary`` grows by increments instead."""

    def apply(df: DataFrame) -> DataFrame:
        aggs = [F.expr(sql).alias(name) for name, sql in measures.items()]
        return df.groupBy(*group_by).agg(*aggs)

    apply.needs_all_rows = True
    return apply


def is_ready(store: ControlStore, pipeline_id: str) -> bool:
    """Do all active parents of the pipeline have a successful latest run?"""
    wanted = store.read("pipeline_dependencies").filter(F.col("pipeline_id") == pipeline_id)
    runs = latest_runs(store.read("audit_pipeline_execution"))
    row = dependency_ready(wanted, runs).first()
    return row is None or row["is_ready"]


def run_layers(
    spark: SparkSession,
    store: ControlStore,
    stages: Sequence[tuple[str, LoadOptions | None]],
    *,
    now: datetime | None = None,
    **common,
) -> list[RunResult]:
    """Run pipelines one after another, each only when its parents have succeeded."""
    store.initialize()
    results = []
    for pipeline_id, options in stages:
        if not is_ready(store, pipeline_id):
            raise NotReady(f"a parent of '{pipeline_id}' has not succeeded")
        results.append(
            run_incremental(spark, store, pipeline_id, now=now, options=options, **common)
        )
    return results

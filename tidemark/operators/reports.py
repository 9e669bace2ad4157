"""Reports over control and audit frames. Everything is grouped before it is joined."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import seconds_between, time_literal
from tidemark.operators.keys import dedup_latest
from tidemark.operators.skew import lookup_join
from tidemark.scratch import Scratch, measure


def latest_runs(executions: DataFrame) -> DataFrame:
    """Current state of every run: its closing row when there is one, else its opening row."""
    closed = F.struct(F.col("execution_end").isNotNull(), F.col("execution_end"))
    rest = [c for c in executions.columns if c != "run_id"]
    return (
        executions.groupBy("run_id")
        .agg(F.max_by(F.struct(*rest), closed).alias("run"))
        .select("run_id", "run.*")
    )


def last_success(runs: DataFrame) -> DataFrame:
    """Per pipeline, start and watermark of its latest successful run."""
    return (
        runs.filter(F.col("status") == "SUCCESS")
        .groupBy("pipeline_id")
        .agg(F.max(F.struct("execution_start", "run_id", "watermark_end")).alias("last"))
        .select("pipeline_id", "last.run_id", "last.execution_start", "last.watermark_end")
    )


def sla_breaches(runs: DataFrame, as_of: Column | datetime, limit_seconds: int) -> DataFrame:
    """Failed runs, and runs still open after ``limit_seconds``."""
    as_of = time_literal(runs, "execution_start", as_of) if isinstance(as_of, datetime) else as_of
    age = seconds_between(F.col("execution_start"), as_of)
    late = (F.col("status") == "RUNNING") & (age > limit_seconds)
    breach = F.when(F.col("status") == "FAILED", "FAILED").when(late, "OVERDUE")
    return (
        runs.withColumn("breach", breach)
        .filter(F.col("breach").isNotNull())
        .withColumn("open_seconds", F.when(F.col("breach") == "OVERDUE", age))
    )


def step_profile(steps: DataFrame) -> DataFrame:
    """Durations per step name, to find the slow one."""
    spent = seconds_between(F.col("start_time"), F.col("end_time"))
    return (
        steps.withColumn("spent", spent)
        .groupBy("step_name")
        .agg(
            F.count(F.lit(1)).alias("n_steps"),
            F.count_if(F.col("status") == "FAILED").alias("n_failed"),
            F.sum("spent").alias("total_seconds"),
            F.avg("spent").alias("avg_seconds"),
            F.max("spent").alias("max_seconds"),
            F.percentile_approx("spent", 0.5, 10000).alias("p50_seconds"),
            F.percentile_approx("spent", 0.95, 10000).alias("p95_seconds"),
            F.sum("records_processed").alias("records_processed"),
        )
    )


def reconcile(counts: DataFrame) -> DataFrame:
    """Add discrepancy and status to frames with source, insert, update and quarantine counts."""
    accounted = (
        F.col("target_inserted_count") + F.col("target_updated_count") + F.col("quarantine_count")
    )
    gap = F.col("source_count") - accounted
    return counts.withColumns(
        {
            "discrepancy_count": gap,
            "reconciliation_status": F.when(gap == 0, "RECONCILED").otherwise("DISCREPANCY"),
        }
    )


def discrepancies(reconciliations: DataFrame) -> DataFrame:
    """Runs that lost or gained rows."""
    return reconciliations.filter(F.col("reconciliation_status") == "DISCREPANCY")


def run_report(
    runs: DataFrame, steps: DataFrame, reconciliations: DataFrame, quality_log: DataFrame
) -> DataFrame:
    """One row per run with its steps, the step that failed, its reconciliation and its quality
    results. Each log is reduced to one row per run first, so no run multiplies another's rows."""
    failed = F.struct("start_time", "step_name")
    per_steps = steps.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.sum(seconds_between(F.col("start_time"), F.col("end_time"))).alias("step_seconds"),
        F.max(F.when(F.col("status") == "FAILED", failed))["step_name"].alias("failed_step"),
        F.max(F.struct("end_time", "step_name"))["step_name"].alias("last_step"),
    )
    per_recon = reconciliations.groupBy("run_id").agg(
        F.sum("source_count").alias("source_count"),
        F.sum("discrepancy_count").alias("discrepancy_count"),
    )
    per_quality = quality_log.groupBy("run_id").agg(
        F.count_if(F.col("status") != "PASSED").alias("n_failed_rules"),
        F.sum("failed_records").alias("failed_records"),
    )
    head = runs.select("run_id", "pipeline_id", "status", "execution_start")
    return (
        head.join(per_steps, "run_id", "left")
        .join(per_recon, "run_id", "left")
        .join(per_quality, "run_id", "left")
    )


def steps_in_order(steps: DataFrame) -> DataFrame:
    return steps.orderBy("start_time", "end_time", "step_run_id")


def dependency_ready(
    dependencies: DataFrame, runs: DataFrame, scratch: Scratch | None = None
) -> DataFrame:
    """Per downstream pipeline: are all parents of its active dependencies ready, that is, did the
    latest run of each succeed? A parent that never ran is not ready. The latest runs are written
    down once, so that their size can be measured before the join."""
    scratch = scratch or Scratch(runs.sparkSession)
    latest = scratch.table(
        runs.groupBy("pipeline_id")
        .agg(F.max(F.struct("execution_start", "run_id", "status"))["status"].alias("status"))
        .withColumnRenamed("pipeline_id", "parent_pipeline_id")
    )
    active = dependencies.filter("is_active").select("pipeline_id", "parent_pipeline_id")
    ok = F.coalesce(F.col("status") == "SUCCESS", F.lit(False))
    return (
        lookup_join(active, latest, ["parent_pipeline_id"], "left", size=measure(latest))
        .groupBy("pipeline_id")
        .agg(
            F.bool_and(ok).alias("is_ready"),
            F.count(F.lit(1)).alias("n_parents"),
            F.count_if(~ok).alias("n_waiting"),
        )
    )


def active_rules(rules: DataFrame, tables: DataFrame) -> DataFrame:
    """Active rules with the pipeline of their table; rules without a table drop out."""
    owner = tables.select("table_id", "pipeline_id")
    return lookup_join(rules.filter("is_active"), owner, ["table_id"], "inner", size=measure(owner))


def source_and_target(pipelines: DataFrame, tables: DataFrame) -> DataFrame:
    """One record per pipeline: its landing source and its first table of another layer, both first
    by (layer, table_id). Pipelines that lack a side keep nulls there."""
    target_cols = ["storage_path", "file_format", "write_mode", "partition_cols", "merge_keys"]
    target_cols = [c for c in target_cols if c in tables.columns]
    landing = F.col("layer") == "landing"
    source = F.struct("table_id", "storage_path", "file_format")
    target = F.struct("layer", "table_id", *target_cols)
    sides = tables.groupBy("pipeline_id").agg(
        F.min(F.when(landing, source)).alias("src"), F.min(F.when(~landing, target)).alias("tgt")
    )
    return pipelines.join(sides, "pipeline_id", "left").select(
        *[pipelines[c] for c in pipelines.columns],
        F.col("src.table_id").alias("source_table_id"),
        F.col("src.storage_path").alias("source_path"),
        F.col("src.file_format").alias("source_format"),
        F.col("tgt.table_id").alias("target_table_id"),
        F.col("tgt.layer").alias("target_layer"),
        *[F.col(f"tgt.{c}").alias("target_path" if c == "storage_path" else c) for c in target_cols
          if c != "file_format"],
    )


def latest_state(control: DataFrame) -> DataFrame:
    """Current watermark row per pipeline from the log of its states."""
    return dedup_latest(control, ["pipeline_id"], ["updated_at"])


def running_totals(reconciliations: DataFrame) -> DataFrame:
    """Totals per pipeline over all its runs."""
    sums = ["source_count", "target_inserted_count", "target_updated_count", "quarantine_count"]
    return reconciliations.groupBy("pipeline_id").agg(
        F.count(F.lit(1)).alias("n_runs"), *(F.sum(c).alias(c) for c in sums)
    )

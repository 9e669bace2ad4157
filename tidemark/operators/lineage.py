"""Lineage stamps, batch tracing and ingestion latency."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import event_time, instant, seconds_between
from tidemark.schemas import BATCH_ID, EXECUTION_ID, FAILED_RULE, LOADED_AT, SOURCE_FILE


def stamp(
    df: DataFrame, batch_id: str, loaded_at: datetime | None = None, *, keep_file: bool = False
) -> DataFrame:
    """Add load time, source file and batch id. ``loaded_at`` is one instant per run, so that a
    row has the same stamp wherever it lands. ``keep_file`` leaves the file stamp of an earlier layer
    in place."""
    moment = F.current_timestamp() if loaded_at is None else instant(loaded_at)
    stamps = {LOADED_AT: moment, SOURCE_FILE: _source_file(df), BATCH_ID: F.lit(batch_id)}
    if keep_file and SOURCE_FILE in df.columns:
        del stamps[SOURCE_FILE]
    return df.withColumns(stamps)


def _source_file(df: DataFrame) -> Column:
    try:
        # the hidden column resolves only over a file scan
        assert df.select("_metadata.file_path").schema
        return F.col("_metadata.file_path")
    except AnalysisException:
        return F.input_file_name()


def trace_batch(target: DataFrame, quarantine: DataFrame | None, run_id: str) -> DataFrame:
    """Every row of one run, landed or quarantined (``failed_rule`` is null for landed rows)."""
    landed = target.filter(F.col(BATCH_ID) == run_id)
    if quarantine is None:
        return landed.withColumn(FAILED_RULE, F.lit(None).cast("string"))
    held = quarantine.filter(F.col(EXECUTION_ID) == run_id).drop(EXECUTION_ID)
    return landed.unionByName(held, allowMissingColumns=True)


def trace_file(target: DataFrame, quarantine: DataFrame | None, file: str) -> DataFrame:
    """Every row that came from one source file."""
    landed = target.filter(F.col(SOURCE_FILE) == file)
    if quarantine is None:
        return landed.withColumn(FAILED_RULE, F.lit(None).cast("string"))
    held = quarantine.filter(F.col(SOURCE_FILE) == file).drop(EXECUTION_ID)
    return landed.unionByName(held, allowMissingColumns=True)


def with_latency(df: DataFrame, column: str, loaded_at: str = LOADED_AT) -> DataFrame:
    """Add ``latency_seconds``, from the event to its load."""
    return df.withColumn(
        "latency_seconds", seconds_between(event_time(df, column), F.col(loaded_at))
    )


def latency_report(df: DataFrame, column: str, by: str = BATCH_ID) -> DataFrame:
    """Latency per group. Every statistic is a mergeable partial aggregate."""
    lag = F.col("latency_seconds")
    return (
        with_latency(df, column)
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(lag).alias("min_seconds"),
            F.max(lag).alias("max_seconds"),
            F.avg(lag).alias("avg_seconds"),
            F.percentile_approx(lag, 0.95, 10000).alias("p95_seconds"),
        )
    )

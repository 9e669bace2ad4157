"""The same load fed by a file stream: each micro-batch is one run.

The stream's checkpoint, not the watermark control row, decides which files are new. A micro-batch
that is retried after a crash carries the same run id and so replaces what it wrote before. The id of
the stream is kept in its checkpoint: a new checkpoint, whose epochs start again, is another stream.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import instant, utc_now
from tidemark.model import ConfigError
from tidemark.operators.increment import Bounds
from tidemark.operators.lineage import stamp
from tidemark.plans.control import ControlStore
from tidemark.plans.runner import (
    LoadOptions,
    RunResult,
    counted_table,
    open_job,
    process,
    transformed,
)
from tidemark.schemas import BATCH_ID, LOADED_AT
from tidemark.sources import storage
from tidemark.sources.files import CORRUPT, keeps_lines, with_corrupt


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    path = f"{checkpoint.rstrip('/')}/stream_id"
    if not storage.exists(spark, path):
        storage.write_text(spark, path, uuid.uuid4().hex[:12])
    return storage.read_text(spark, path)


def ingest_available(
    spark: SparkSession,
    store: ControlStore,
    pipeline_id: str,
    *,
    schema: T.StructType | str,
    checkpoint: str,
    options: LoadOptions | None = None,
    environment: str = "dev",
    max_files_per_trigger: int | None = None,
) -> list[RunResult]:
    """Load everything that has arrived since the last call, then stop."""
    options = options or LoadOptions()
    store.initialize()
    if not store.pipeline(pipeline_id).is_active:
        return []
    source, _ = store.source_and_target(pipeline_id)
    reader = spark.readStream.format(source.file_format).options(**options.read_options)
    if keeps_lines(source.file_format, options.read_options):
        schema = with_corrupt(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # the file name is known to the scan only; time and batch are stamped per micro-batch
    stream = stamp(reader.load(source.storage_path), "").drop(LOADED_AT, BATCH_ID)
    results: list[RunResult] = []
    stream_id = _stream_id(spark, checkpoint)

    def load(rows: DataFrame, epoch: int) -> None:
        now = utc_now()
        run_id = f"{quote(pipeline_id, safe='')}-stream-{stream_id}-{epoch}"
        column = "last_updated_at"
        job = open_job(
            rows.sparkSession, store, pipeline_id, now, run_id, environment, column, options
        )
        if job is None:  # an error keeps the micro-batch for the next call
            raise ConfigError(f"pipeline '{pipeline_id}' was switched off during the stream")
        job.bounds = Bounds(None, None)
        with job.guard():
            with job.log.step("extract") as step:
                stamped = rows.withColumns(
                    {LOADED_AT: instant(now), BATCH_ID: F.lit(run_id)}
                )
                staged, n_read = counted_table(job.scratch, transformed(job, stamped))
                step["records"] = n_read
            results.append(process(job, staged, n_read))

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results

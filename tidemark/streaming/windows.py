"""Streams whose state outlives micro-batches: windows of event time and first rows per key.

The state is Spark's state store, under the stream's checkpoint: a stream that is stopped and started again
goes on where it stood. Results are appended to a versioned table, one segment per micro-batch, so that
a micro-batch that is repeated after a crash replaces what it wrote. ``delay`` bounds the state: rows that
come later than that behind the newest event time seen are left out, and what is older is forgotten.
Rows without an event time belong to no window and are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.summary import Measure
from tidemark.sources.tables import VersionedTable


def _timed(stream: DataFrame, column: str, delay: str) -> DataFrame:
    # event time has to be an instant; a wall clock is one in the session's zone
    timed = stream.withColumn(column, F.col(column).cast("timestamp")).filter(F.col(column).isNotNull())
    return timed.withWatermark(column, delay)


def _summed(grouped, measures: Sequence[Measure], window: str, keys: Sequence[str]) -> DataFrame:
    one = F.lit(1)
    states = grouped.agg(*[c for m in measures for c in m.partial(one)])
    return states.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"),
        *keys, *[m.result() for m in measures],
    )


def tumbling(
    stream: DataFrame, column: str, size: str, delay: str, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Measures per key and window of ``size``; a window comes out once the newest event time is ``delay``
    beyond its end."""
    window = F.window(column, size).alias("w")
    return _summed(_timed(stream, column, delay).groupBy(window, *keys), measures, "w", keys)


def sessions(
    stream: DataFrame, column: str, gap: str, delay: str, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Measures per key and session: events less than ``gap`` apart. A session comes out once the newest
    event time is ``delay`` beyond its end, which is ``gap`` after its last event."""
    window = F.session_window(column, gap).alias("w")
    return _summed(_timed(stream, column, delay).groupBy(window, *keys), measures, "w", keys)


def unique_within(stream: DataFrame, column: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """The first row of each key; others of the key are left out as long as the key is remembered, for
    ``delay`` of event time after its first row."""
    return _timed(stream, column, delay).dropDuplicatesWithinWatermark(list(keys))


def append_available(
    spark: SparkSession, result: DataFrame, path: str, checkpoint: str, partition_cols: Sequence[str] = ()
) -> VersionedTable:
    """Append what the stream's new input yields to the table under ``path``, then stop."""
    table = VersionedTable(spark, path)
    table.create(result.schema, list(partition_cols))

    def append(rows: DataFrame, epoch: int) -> None:
        VersionedTable(rows.sparkSession, path).append(rows, f"epoch-{epoch:012d}", counted=False)

    query = (
        result.writeStream.foreachBatch(append)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table

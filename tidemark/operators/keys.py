"""Repeated keys and the latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count ``n``. Nulls are one key. Counts are
    combined before the shuffle, so a key of any size arrives as one row per map task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dedup_latest(df: DataFrame, keys: list[str], latest_by: list[str]) -> DataFrame:
    """One row per key: the greatest ``latest_by``, then the greatest remaining columns, so that the
    choice does not depend on row order. Spark keeps one candidate per key and map task before the
    shuffle (``WindowGroupLimit``), which also bounds hot keys."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys + latest_by and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    order = [F.col(c).desc_nulls_last() for c in latest_by + rest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")

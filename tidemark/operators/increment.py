"""Incremental windows ``(start, end]`` over an event-time column."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import event_time, minutes_before, time_literal
from tidemark.model import WatermarkState


@dataclass(frozen=True)
class Bounds:
    start: datetime | None
    end: datetime | None
    is_backfill: bool = False


def resolve_bounds(state: WatermarkState | None, now: datetime) -> Bounds:
    """Window of the next run: the active backfill range, else everything since the watermark."""
    if state is None:
        return Bounds(None, now)
    if state.backfill_status == "ACTIVE":
        return Bounds(state.backfill_start, state.backfill_end, is_backfill=True)
    start = state.last_watermark_value
    if start is not None and state.lookback_minutes > 0:
        start -= timedelta(minutes=state.lookback_minutes)
    return Bounds(start, now)


def control_bounds(control: DataFrame, now: datetime) -> DataFrame:
    """``resolve_bounds`` for every row of a watermark control frame at once."""
    active = F.col("backfill_status") == "ACTIVE"
    last = F.col("last_watermark_value")
    lagged = F.when(
        F.col("lookback_minutes") > 0, minutes_before(last, F.col("lookback_minutes"))
    ).otherwise(last)
    end = time_literal(control, "backfill_end", now)
    return control.select(
        "*",
        F.when(active, F.col("backfill_start")).otherwise(lagged).alias("window_start"),
        F.when(active, F.col("backfill_end")).otherwise(end).alias("window_end"),
    )


def in_window(df: DataFrame, column: str, start: datetime | None, end: datetime | None) -> Column:
    """Predicate ``start < column <= end``; a missing bound is open, both missing is TRUE."""
    moment = event_time(df, column)
    test = None
    if start is not None:
        test = moment > time_literal(df, column, start)
    if end is not None:
        upper = moment <= time_literal(df, column, end)
        test = upper if test is None else test & upper
    return F.lit(True) if test is None else test


def select_increment(
    df: DataFrame,
    column: str | None,
    start: datetime | None = None,
    end: datetime | None = None,
    *,
    on_missing: str = "full",
    keep_unreadable: bool = False,
) -> DataFrame:
    """Rows inside the window. A frame without the column is loaded in full, or rejected with
    ``on_missing="error"``. Rows whose time is null or unreadable fall outside any bound;
    ``keep_unreadable`` adds them, for a caller that deals with them."""
    if column is None or column not in df.columns:
        if column is not None:
            if on_missing == "error":
                raise ValueError(f"watermark column '{column}' not in {df.columns}")
            warnings.warn(f"watermark column '{column}' not found: full load", stacklevel=2)
        return df
    if start is None and end is None:
        return df
    test = in_window(df, column, start, end)
    return df.filter(test | event_time(df, column).isNull() if keep_unreadable else test)


def window_profile(
    df: DataFrame, column: str, start: datetime | None, end: datetime | None
) -> DataFrame:
    """One row: how many rows the window takes, and where the others are."""
    moment, inside = event_time(df, column), in_window(df, column, start, end)
    known = moment.isNotNull()
    below = known & (moment <= time_literal(df, column, start)) if start else F.lit(False)
    above = known & (moment > time_literal(df, column, end)) if end else F.lit(False)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.coalesce(inside, F.lit(False))).alias("window_rows"),
        F.count_if(below).alias("before_rows"),
        F.count_if(above).alias("after_rows"),
        F.count_if(F.col(column).isNull()).alias("null_rows"),
        F.count_if(F.col(column).isNotNull() & moment.isNull()).alias("unreadable_rows"),
    )


def next_watermark(df: DataFrame, column: str, previous: datetime | None = None) -> DataFrame:
    """One row: the greatest event time of ``df``, or the previous watermark when it has none."""
    top = F.max(event_time(df, column))
    if previous is not None:
        top = F.coalesce(top, time_literal(df, column, previous))
    return df.agg(top.alias("watermark"))

"""Time columns: parsing, arithmetic and typed literals.

Naive times on the driver are wall-clock times in UTC, whatever the zone of the process or the session:
a wall clock with summer time skips an hour and repeats another.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A text that names its zone: Z, an offset or a region at its end, after a time of day.
ZONED = r":\d{2}(\.\d+)?\s*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+)\s*$"
_EPOCH = "1970-01-01 00:00:00"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def as_utc(value: datetime) -> datetime:
    """The instant of a time, which is in UTC unless it names its zone."""
    return value.astimezone(timezone.utc) if value.tzinfo else value.replace(tzinfo=timezone.utc)


def instant(value: datetime) -> Column:
    """Timestamp literal."""
    micros = (as_utc(value) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def wall_clocks(df: DataFrame) -> DataFrame:
    """``df`` with all timestamps as wall-clock times in UTC, to be collected: Spark hands timestamps out in
    the zone of the process."""
    columns = {f.name: utc_wall_clock(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(columns) if columns else df


def utc_wall_clock(instant: Column) -> Column:
    """An instant as a wall-clock time in UTC, whatever the session's zone."""
    micros = F.unix_micros(instant)
    whole = F.make_dt_interval(secs=(micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)"))
    return F.lit(_EPOCH).cast("timestamp_ntz") + whole


def parse_time(text: Column) -> Column:
    """Wall-clock time of a text column, as a cast reads it: date and time separated by a space or T,
    seconds, minutes and fractions optional. A text with a zone or offset is an instant and gives its
    wall clock in UTC. NULL, never an error, where nothing fits."""
    return F.when(text.rlike(ZONED), utc_wall_clock(text.try_cast("timestamp"))).otherwise(
        text.try_cast("timestamp_ntz")
    )


def readable_sql(df: DataFrame, column: str) -> str:
    """SQL predicate that holds for rows whose time is present and readable."""
    name = f"`{column}`"
    if not isinstance(df.schema[column].dataType, T.StringType):
        return f"{name} IS NOT NULL"
    zoned = ZONED.replace("\\", "\\\\")
    return f"CASE WHEN {name} RLIKE '{zoned}' THEN try_cast({name} AS timestamp) IS NOT NULL ELSE try_cast({name} AS timestamp_ntz) IS NOT NULL END"


def event_time(df: DataFrame, column: str) -> Column:
    """``column`` as a time. Typed columns are returned bare so that scans can push filters down;
    text is read as wall-clock time."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return parse_time(F.col(column))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column)
    raise TypeError(f"watermark column '{column}' is {kind.simpleString()}, not a time or text")


def time_literal(df: DataFrame, column: str, value: datetime) -> Column:
    """Bound of the type ``column`` compares with, so that the column itself is not cast."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return instant(value)
    return F.lit(as_utc(value).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def latest_time(df: DataFrame, column: str, moment: Column) -> Column:
    """Greatest of ``moment``, which is derived from ``column``, as wall-clock time."""
    top = F.max(moment)
    return utc_wall_clock(top) if isinstance(df.schema[column].dataType, T.TimestampType) else top.cast("timestamp_ntz")


def minutes_before(moment: Column, minutes: Column | int) -> Column:
    minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
    return moment - F.make_dt_interval(mins=minutes.cast("int"))


def seconds_between(start: Column, end: Column) -> Column:
    """Complete seconds from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", start, end)

"""Control tables: configuration of pipelines, tables, columns and rules, and watermark state."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, replace
from datetime import datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import as_utc, utc_now, wall_clocks
from tidemark.model import LAYERS, ColumnSpec, ConfigError, Pipeline, Rule, Table, WatermarkState
from tidemark.operators.reports import latest_state
from tidemark.operators.upsert import update_where
from tidemark.schemas import AUDIT_SCHEMAS, CONTROL_SCHEMAS
from tidemark.sources.tables import VersionedTable


_ARROW = {
    T.StringType(): pa.string(),
    T.LongType(): pa.int64(),
    T.BooleanType(): pa.bool_(),
    T.TimestampType(): pa.timestamp("us", tz="UTC"),
    T.ArrayType(T.StringType()): pa.list_(pa.string()),
}


def _instant(value):
    return as_utc(value) if isinstance(value, datetime) else value


class ControlStore:
    """The control and audit tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> VersionedTable:
        kind = "audit" if name in AUDIT_SCHEMAS else "control"
        return VersionedTable(self.spark, f"{self.root}/{kind}/{name}")

    def quarantine(self, pipeline_id: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/quarantine/{quote(pipeline_id, safe='')}")

    def initialize(self) -> None:
        """Create the tables that are missing, empty; leave the others alone."""
        schemas = {**CONTROL_SCHEMAS, **AUDIT_SCHEMAS}
        with ThreadPoolExecutor(len(schemas)) as pool:  # each lists a folder of its own
            list(pool.map(lambda name: self.table(name).create(schemas[name]), schemas))

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def rows(self, name: str, rows: list[dict]) -> DataFrame:
        """A few typed rows as a local relation, which needs no Python workers. Naive times are in UTC."""
        schema = {**CONTROL_SCHEMAS, **AUDIT_SCHEMAS}[name]
        columns = {f.name: [_instant(r.get(f.name)) for r in rows] for f in schema.fields}
        arrays = [pa.array(columns[f.name], _ARROW[f.dataType]) for f in schema.fields]
        return self.spark.createDataFrame(pa.Table.from_arrays(arrays, schema.names), schema)

    def replace(self, name: str, rows: list[dict]) -> None:
        self.table(name).overwrite(self.rows(name, rows), f"seed-{uuid.uuid4()}", counted=False)

    def append(self, name: str, rows: list[dict], batch_id: str) -> None:
        if rows:
            self.table(name).append(self.rows(name, rows).coalesce(1), batch_id, counted=False)

    def update(self, name: str, condition: str | Column, values: dict[str, Column]) -> None:
        """Set columns on the rows that meet a condition."""
        table = self.table(name)
        table.overwrite(update_where(table.read(), condition, values), f"update-{uuid.uuid4()}", counted=False)

    # -- lookups for one pipeline: a handful of rows --------------------------------------------
    def pipeline(self, pipeline_id: str) -> Pipeline:
        found = self.read("pipeline_config").filter(F.col("pipeline_id") == pipeline_id)
        found = wall_clocks(found).take(2)
        if len(found) != 1:
            state = "not found" if not found else "declared twice"
            raise ConfigError(f"pipeline '{pipeline_id}' is {state}")
        return Pipeline(**found[0].asDict())

    def tables(self, pipeline_id: str) -> list[Table]:
        found = (
            self.read("table_config")
            .filter(F.col("pipeline_id") == pipeline_id)
            .orderBy("layer", "table_id")
        )
        return [
            Table(
                **{
                    **r.asDict(),
                    "partition_cols": tuple(r["partition_cols"] or ()),
                    "merge_keys": tuple(r["merge_keys"] or ()),
                }
            )
            for r in found.collect()
        ]

    def source_and_target(self, pipeline_id: str) -> tuple[Table, Table]:
        """The lowest layer is the source, the next one the target."""
        return self.ends(pipeline_id, self.tables(pipeline_id))

    def ends(self, pipeline_id: str, tables: list[Table]) -> tuple[Table, Table]:
        tables = sorted(tables, key=lambda t: LAYERS.index(t.layer))
        source = tables[0] if tables else None
        target = next((t for t in tables if t.layer != source.layer), None)
        if target is None:
            raise ConfigError(f"pipeline '{pipeline_id}' lacks a source or a target table")
        return source, target

    def columns(self, table_id: str) -> list[ColumnSpec]:
        found = self.read("column_config").filter(F.col("table_id") == table_id)
        return [
            ColumnSpec(r["column_name"], r["data_type"], r["is_nullable"], r["is_primary_key"])
            for r in found.orderBy("column_id").collect()
        ]

    def rules(self, pipeline_id: str) -> list[Rule]:
        """Active rules of all tables of the pipeline, by rule id."""
        return self.rules_of(self.tables(pipeline_id))

    def rules_of(self, tables: list[Table]) -> list[Rule]:
        wanted = F.col("is_active") & F.col("table_id").isin([t.table_id for t in tables])
        found = self.read("dq_rules").filter(wanted).orderBy("rule_id").collect()
        return [
            Rule(
                r["rule_id"],
                r["column_name"],
                r["rule_type"],
                r["expression"],
                r["action_on_fail"],
            )
            for r in found
        ]

    # -- watermark state ------------------------------------------------------------------------
    # Every change appends the pipeline's new state, so that pipelines never overwrite each other.
    def watermark(self, pipeline_id: str) -> WatermarkState | None:
        states = self.read("watermark_control").filter(F.col("pipeline_id") == pipeline_id)
        found = wall_clocks(latest_state(states)).take(1)
        return WatermarkState(**found[0].asDict()) if found else None

    def put_watermark(self, state: WatermarkState, now: datetime | None = None) -> None:
        """Append a state. One derived from an earlier state never sorts before it."""
        now = now or utc_now()
        if state.updated_at is not None and state.updated_at >= now:
            now = state.updated_at + timedelta(microseconds=1)
        row = asdict(replace(state, updated_at=now))
        self.append("watermark_control", [row], f"{state.pipeline_id}-{uuid.uuid4()}")

    def advance_watermark(self, pipeline_id: str, value: datetime | None, now=None) -> bool:
        """Store a new watermark value; nothing happens for a pipeline without a state."""
        state = self.watermark(pipeline_id)
        if state is None:
            return False
        self.put_watermark(replace(state, last_watermark_value=value), now)
        return True

    def set_backfill(
        self,
        pipeline_id: str,
        status: str,
        start: datetime | None = None,
        end: datetime | None = None,
        now: datetime | None = None,
    ) -> bool:
        """Set the backfill status, and the range when one is given. The watermark is untouched."""
        state = self.watermark(pipeline_id)
        if state is None:
            return False
        changed = replace(state, backfill_status=status)
        if start is not None or end is not None:
            changed = replace(changed, backfill_start=start, backfill_end=end)
        self.put_watermark(changed, now)
        return True

"""Upkeep of the tables that every run adds to."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.times import utc_now
from tidemark.plans.control import ControlStore
from tidemark.schemas import AUDIT_SCHEMAS

GROWING = (*AUDIT_SCHEMAS, "watermark_control")


def tidy(store: ControlStore, before: datetime | None = None) -> dict[str, int]:
    """Fold the small segments that the audit tables, the watermark log and the quarantines of all pipelines
    took before a time (UTC; a day ago by default) into few, beside runs that go on appending. Returns how
    many segments less each table has. Reading these tables then costs what they hold, not how many runs
    there were."""
    before = before or utc_now() - timedelta(days=1)
    tables = {name: store.table(name) for name in GROWING}
    for r in store.read("pipeline_config").select("pipeline_id").distinct().orderBy(F.col("pipeline_id")).toLocalIterator():
        tables[f"quarantine/{r.pipeline_id}"] = store.quarantine(r.pipeline_id)
    return {name: table.fold_segments(before) for name, table in tables.items()}

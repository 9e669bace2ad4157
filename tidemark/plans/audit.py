"""Audit trail of one run, collected on the driver and appended once per phase."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime

from tidemark.functions.times import utc_now
from tidemark.model import RunContext
from tidemark.plans.control import ControlStore


class RunLog:
    """Rows of one run: an opening row at once, everything else when the run closes."""

    def __init__(self, store: ControlStore, pipeline_id: str, ctx: RunContext):
        self.store, self.pipeline_id, self.ctx = store, pipeline_id, ctx
        self.steps: list[dict] = []
        self.reconciliations: list[dict] = []
        self.quality: list[dict] = []

    def _execution(self, **values) -> dict:
        return {
            "run_id": self.ctx.run_id,
            "pipeline_id": self.pipeline_id,
            "execution_start": self.ctx.execution_time,
            "watermark_start": self.ctx.watermark,
            **values,
        }

    def open(self) -> None:
        row = self._execution(status="RUNNING")
        self.store.append("audit_pipeline_execution", [row], f"{self.ctx.run_id}-open")

    @contextmanager
    def step(self, name: str):
        """Time a step. The body sets ``records`` on the yielded dict; an error marks it FAILED."""
        entry = {
            "step_run_id": str(uuid.uuid4()),
            "run_id": self.ctx.run_id,
            "step_name": name,
            "start_time": utc_now(),
            "status": "SUCCESS",
            "records_processed": 0,
        }
        note: dict = {"records": 0}
        try:
            yield note
        except Exception as error:
            entry.update(status="FAILED", error_details=str(error))
            raise
        finally:
            entry.update(end_time=utc_now(), records_processed=note["records"])
            self.steps.append(entry)

    def rule(self, rule_id: str, failed: int, status: str, path: str | None = None) -> None:
        self.quality.append(
            {
                "log_id": str(uuid.uuid4()),
                "run_id": self.ctx.run_id,
                "rule_id": rule_id,
                "failed_records": failed,
                "quarantine_path": path,
                "status": status,
            }
        )

    def reconcile(
        self,
        source: int,
        inserted: int,
        updated: int,
        quarantined: int,
        notes: str = "",
        skipped: int = 0,
    ) -> int:
        """Note the counts; returns the rows they do not account for. Rows skipped on purpose, as older
        than what is stored, are accounted for in the notes."""
        gap = source - (inserted + updated + quarantined + skipped)
        self.reconciliations.append(
            {
                "reconciliation_id": str(uuid.uuid4()),
                "run_id": self.ctx.run_id,
                "pipeline_id": self.pipeline_id,
                "source_count": source,
                "target_inserted_count": inserted,
                "target_updated_count": updated,
                "quarantine_count": quarantined,
                "discrepancy_count": gap,
                "reconciliation_status": "RECONCILED" if gap == 0 else "DISCREPANCY",
                "notes": notes,
            }
        )
        return gap

    def close(
        self,
        status: str,
        watermark_end: datetime | None = None,
        records_read: int = 0,
        records_written: int = 0,
        error: str | None = None,
    ) -> None:
        run = self.ctx.run_id
        logs = {
            "audit_pipeline_steps": self.steps,
            "audit_data_reconciliation": self.reconciliations,
            "data_quality_log": self.quality,
        }
        with ThreadPoolExecutor(len(logs)) as pool:
            list(pool.map(lambda name: self.store.append(name, logs[name], run), logs))
        last = self._execution(
            execution_end=utc_now(),
            watermark_end=watermark_end,
            records_read=records_read,
            records_written=records_written,
            status=status,
            error_message=error,
        )
        self.store.append("audit_pipeline_execution", [last], f"{run}-close")

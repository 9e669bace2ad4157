"""Typed configuration records and the enumerations they draw from."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime

from tidemark.functions.times import utc_now

# Fixed values of the configuration vocabulary.
LAYERS = ("landing", "bronze", "silver", "gold")
WRITE_MODES = ("append", "overwrite", "merge", "replace_partitions")
RULE_TYPES = ("NOT_NULL", "UNIQUE", "RANGE", "MIN_VAL", "REGEX", "EXPRESSION")
ACTIONS = ("QUARANTINE", "WARN", "FAIL_PIPELINE")


class ConfigError(ValueError):
    """Configuration that cannot be acted on."""


class QualityHalt(ValueError):
    """A FAIL_PIPELINE rule found violations."""

    def __init__(self, rule_id: str, failed: int):
        super().__init__(f"quality rule '{rule_id}' halted the run: {failed} failing rows")
        self.rule_id, self.failed = rule_id, failed


@dataclass(frozen=True)
class RunContext:
    """Identity of one run; fixed at start so that every copy of a row carries the same stamps."""

    pipeline_name: str
    environment: str = "dev"
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    execution_time: datetime = field(default_factory=utc_now)
    watermark: datetime | None = None


@dataclass(frozen=True)
class Pipeline:
    pipeline_id: str
    pipeline_name: str
    description: str | None
    schedule_cron: str | None
    is_active: bool
    created_at: datetime


@dataclass(frozen=True)
class Table:
    table_id: str
    pipeline_id: str
    layer: str
    table_name: str
    storage_path: str
    file_format: str
    write_mode: str
    partition_cols: tuple[str, ...] = ()
    merge_keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class ColumnSpec:
    column_name: str
    data_type: str
    is_nullable: bool = True
    is_primary_key: bool = False


@dataclass(frozen=True)
class Rule:
    """One quality rule. ``column_name`` may name several columns, comma-separated, for UNIQUE."""

    rule_id: str
    column_name: str
    rule_type: str
    expression: str = ""
    action_on_fail: str = "QUARANTINE"

    def __post_init__(self):
        object.__setattr__(self, "rule_type", self.rule_type.upper())
        object.__setattr__(self, "action_on_fail", self.action_on_fail.upper())
        if self.rule_type not in RULE_TYPES:
            raise ConfigError(f"rule '{self.rule_id}': unknown rule type '{self.rule_type}'")
        if self.action_on_fail not in ACTIONS:
            raise ConfigError(f"rule '{self.rule_id}': unknown action '{self.action_on_fail}'")
        if self.rule_type in ("RANGE", "MIN_VAL", "REGEX", "EXPRESSION") and not self.expression:
            raise ConfigError(f"rule '{self.rule_id}': {self.rule_type} needs an expression")

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in self.column_name.split(",")]


@dataclass(frozen=True)
class WatermarkState:
    watermark_id: str
    pipeline_id: str
    table_id: str
    watermark_column: str
    last_watermark_value: datetime | None = None
    lookback_minutes: int = 0
    backfill_status: str = "NONE"
    backfill_start: datetime | None = None
    backfill_end: datetime | None = None
    updated_at: datetime | None = None

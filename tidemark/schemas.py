"""Fixed schemas of the control and audit tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of each table as name, type, nullable.
CONTROL_SCHEMAS = {
    "pipeline_config": T.StructType()
    .add("pipeline_id", "string", False)
    .add("pipeline_name", "string", False)
    .add("description", "string", True)
    .add("schedule_cron", "string", True)
    .add("is_active", "boolean", False)
    .add("created_at", "timestamp", False),
    "table_config": T.StructType()
    .add("table_id", "string", False)
    .add("pipeline_id", "string", False)
    .add("layer", "string", False)
    .add("table_name", "string", False)
    .add("storage_path", "string", False)
    .add("file_format", "string", False)
    .add("write_mode", "string", False)
    .add("partition_cols", T.ArrayType(T.StringType()), True)
    .add("merge_keys", T.ArrayType(T.StringType()), True),
    "column_config": T.StructType()
    .add("column_id", "string", False)
    .add("table_id", "string", False)
    .add("column_name", "string", False)
    .add("data_type", "string", False)
    .add("is_nullable", "boolean", False)
    .add("is_primary_key", "boolean", False)
    .add("description", "string", True),
    "dq_rules": T.StructType()
    .add("rule_id", "string", False)
    .add("table_id", "string", False)
    .add("column_name", "string", False)
    .add("rule_type", "string", False)
    .add("expression", "string", False)
    .add("action_on_fail", "string", False)
    .add("is_active", "boolean", False),
    "pipeline_dependencies": T.StructType()
    .add("dependency_id", "string", False)
    .add("pipeline_id", "string", False)
    .add("parent_pipeline_id", "string", False)
    .add("is_active", "boolean", False),
    "watermark_control": T.StructType()
    .add("watermark_id", "string", False)
    .add("pipeline_id", "string", False)
    .add("table_id", "string", False)
    .add("watermark_column", "string", False)
    .add("last_watermark_value", "timestamp", True)
    .add("lookback_minutes", "long", False)
    .add("backfill_status", "string", False)
    .add("backfill_start", "timestamp", True)
    .add("backfill_end", "timestamp", True)
    .add("updated_at", "timestamp", False),
}

AUDIT_SCHEMAS = {
    "audit_pipeline_execution": T.StructType()
    .add("run_id", "string", False)
    .add("pipeline_id", "string", False)
    .add("execution_start", "timestamp", False)
    .add("execution_end", "timestamp", True)
    .add("watermark_start", "timestamp", True)
    .add("watermark_end", "timestamp", True)
    .add("records_read", "long", True)
    .add("records_written", "long", True)
    .add("status", "string", False)
    .add("error_message", "string", True),
    "audit_pipeline_steps": T.StructType()
    .add("step_run_id", "string", False)
    .add("run_id", "string", False)
    .add("step_name", "string", False)
    .add("start_time", "timestamp", False)
    .add("end_time", "timestamp", False)
    .add("status", "string", False)
    .add("records_processed", "long", True)
    .add("error_details", "string", True),
    "audit_data_reconciliation": T.StructType()
    .add("reconciliation_id", "string", False)
    .add("run_id", "string", False)
    .add("pipeline_id", "string", False)
    .add("source_count", "long", False)
    .add("target_inserted_count", "long", False)
    .add("target_updated_count", "long", False)
    .add("quarantine_count", "long", False)
    .add("discrepancy_count", "long", False)
    .add("reconciliation_status", "string", False)
    .add("notes", "string", True),
    "audit_run_parents": T.StructType()
    .add("run_id", "string", False)
    .add("parent_run_id", "string", False),
    "data_quality_log": T.StructType()
    .add("log_id", "string", False)
    .add("run_id", "string", False)
    .add("rule_id", "string", False)
    .add("failed_records", "long", False)
    .add("quarantine_path", "string", True)
    .add("status", "string", False),
}

# Columns every ingested row carries.
LOADED_AT = "ingestion_timestamp"
SOURCE_FILE = "source_file_name"
BATCH_ID = "batch_id"
# Columns every quarantined row carries on top.
FAILED_RULE = "failed_rule"
EXECUTION_ID = "execution_id"

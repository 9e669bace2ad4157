"""One or more queries per operator. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import parse_time
from tidemark.model import ColumnSpec, QualityHalt, Rule, WatermarkState
from tidemark.operators import conformance, increment, lineage, quality, reports, upsert
from tidemark.operators.keys import dedup_latest
from tidemark.plans.control import ControlStore
from tidemark.plans.layers import conformed_latest, rollup
from tidemark.plans.load import write_table
from tidemark.plans.runner import LoadOptions, run_incremental
from tidemark.scratch import Scratch
from tidemark.sources import storage
from tidemark.sources.files import read_source
from tidemark.sources.tables import VersionedTable
from tidemark.streaming.ingest import ingest_available
from workload import data
from workload.data import ntz, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


START, END = datetime(2024, 1, 10), datetime(2024, 1, 20, 12)
PAIR = ["l_orderkey", "l_linenumber"]
LINE_RULES = [
    Rule("quantity_range", "l_quantity", "RANGE", "l_quantity BETWEEN 3 AND 48"),
    Rule("flag_known", "l_returnflag", "REGEX", "^[AN]$"),
    Rule("pair_unique", ",".join(PAIR), "UNIQUE"),
    Rule("discount_low", "l_discount", "MIN_VAL", "l_discount < 0.09"),
]
WARN_RULES = [
    Rule("tax_high", "l_tax", "RANGE", "l_tax < 0.07", "WARN"),
    Rule("quantity_range", "l_quantity", "RANGE", "l_quantity BETWEEN 3 AND 48"),
    Rule("flag_known", "l_returnflag", "REGEX", "^[AN]$", "WARN"),
    Rule("pair_unique", ",".join(PAIR), "UNIQUE", "", "WARN"),
    Rule("price_positive", "l_extendedprice", "RANGE", "l_extendedprice > 0", "FAIL_PIPELINE"),
    Rule("status_known", "l_linestatus", "NOT_NULL", "", "FAIL_PIPELINE"),
]
EXPRESSION_RULES = [
    Rule("small_quantity", "l_quantity", "EXPRESSION", "l_quantity > 5"),
    Rule("taxed", "l_tax", "EXPRESSION", "l_tax > 0"),
    Rule("shipped_late", "l_shipdate", "EXPRESSION", "year(l_shipdate) < 2001"),
    Rule("pair_unique", ",".join(PAIR), "UNIQUE"),
]
CUSTOMER_COLUMNS = [
    ColumnSpec("c_custkey", "bigint", False, True),
    ColumnSpec("c_name", "bigint", True),
    ColumnSpec("c_nationkey", "string", False),
    ColumnSpec("c_acctbal", "double", False),
    ColumnSpec("c_mktsegment", "date", True),
    ColumnSpec("c_phone", "string", True),
]
ORDER_COLUMNS = [
    ColumnSpec("o_orderkey", "string", False, True),
    ColumnSpec("o_custkey", "int", False),
    ColumnSpec("o_orderdate", "date"),
    ColumnSpec("o_orderpriority", "bigint"),
    ColumnSpec("o_clerk", "string"),
]


# -- scans, lineage, windows --------------------------------------------------------------------
@query
def ingest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_source(spark, data.path(sf_dir, "events"), "PARQUET")
    rows = increment.select_increment(events, None)
    return lineage.stamp(rows, "batch-001").select(
        "event_id", "ts", "user_id", "event_type", "value", "props", "batch_id"
    )


@query
def lineage_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = datetime(2024, 2, 1)
    rows = lineage.stamp(table(spark, sf_dir, "events"), "batch-001", loaded)
    file = F.regexp_extract("source_file_name", r"([^/]+\.parquet)", 1)
    return rows.select(
        "event_id",
        "batch_id",
        file.alias("source_file"),
        F.col("ingestion_timestamp").cast("timestamp_ntz").alias("loaded_at"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")


@query
def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment.select_increment(_events(spark, sf_dir), "ts", START, END)


@query
def incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = WatermarkState("w", "p", "t", "ts", START, lookback_minutes=60)
    bounds = increment.resolve_bounds(state, END)
    return increment.select_increment(_events(spark, sf_dir), "ts", bounds.start, bounds.end)


@query
def backfill_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = WatermarkState(
        "w", "p", "t", "ts", END, 30, "ACTIVE", datetime(2024, 1, 3), datetime(2024, 1, 5, 6)
    )
    bounds = increment.resolve_bounds(state, datetime(2024, 2, 1))
    return increment.select_increment(_events(spark, sf_dir), "ts", bounds.start, bounds.end)


@query
def control_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next window of every pipeline, from its current state."""
    current = reports.latest_state(data.watermark_log(spark, sf_dir))
    bounds = increment.control_bounds(current, datetime(2024, 2, 1))
    return bounds.select("pipeline_id", "backfill_status", "window_start", "window_end")


def _text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text: separated by T or a space, days only, or unreadable."""
    kind = F.col("event_type")
    rendered = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "error", F.concat(F.lit("at "), F.date_format("ts", "dd.MM.yyyy")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", rendered.alias("seen"))


@query
def incremental_string_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment.select_increment(_text_times(spark, sf_dir), "seen", START, END)


@query
def unreadable_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment.window_profile(_text_times(spark, sf_dir), "seen", START, END)


@query
def null_watermark_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", known)
    return increment.window_profile(
        orders, "o_orderdate", datetime(1996, 1, 1), datetime(1999, 1, 1)
    )


@query
def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest event time among the clean rows of a window."""
    rows = increment.select_increment(table(spark, sf_dir, "events"), "ts", START, END)
    rules = [Rule("value_low", "value", "RANGE", "value < 60"), Rule("typed", "event_type", "REGEX", "^[^e]")]
    clean = quality.clean_rows(quality.tag_violations(rows, rules))
    return increment.next_watermark(clean, "ts", START)


# -- data quality -------------------------------------------------------------------------------
def _failing(df: DataFrame, rule: Rule, *columns: str) -> DataFrame:
    tagged = quality.tag_violations(df, [rule], read_once=True)
    return quality.quarantine_rows(tagged, "run-1").select(*columns, "failed_rule", "execution_id")


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    events = table(spark, sf_dir, "events").withColumn("event_type", kind)
    return _failing(events, Rule("typed", "event_type", "NOT_NULL"), "event_id", "user_id")


@query
def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Rule("balance_positive", "c_acctbal", "RANGE", "c_acctbal > 0")
    return _failing(table(spark, sf_dir, "customer"), rule, "c_custkey", "c_acctbal")


@query
def dq_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Rule("name_form", "c_name", "REGEX", "^Customer#[0-9]*[05]$")
    return _failing(table(spark, sf_dir, "customer"), rule, "c_custkey", "c_name")


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Rule("pair_unique", ",".join(PAIR), "UNIQUE")
    return _failing(
        table(spark, sf_dir, "lineitem"), rule, *PAIR, "l_partkey", "l_suppkey", "l_quantity"
    )


@query
def dq_unique_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the keys is null: nulls are one repeated key."""
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    orders = table(spark, sf_dir, "orders").withColumn("k", key)
    return _failing(orders, Rule("k_unique", "k", "UNIQUE"), "o_orderkey", "k")


def _tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.tag_violations(table(spark, sf_dir, "lineitem"), LINE_RULES, read_once=True)


LINE = [*PAIR, "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag"]


@query
def dq_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged_lines(spark, sf_dir).select(*LINE, "failed_rule")


@query
def dq_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_rows(_tagged_lines(spark, sf_dir)).select(*LINE)


@query
def dq_quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rows as they are stored: appended to a table partitioned by rule, then read back."""
    held = quality.quarantine_rows(_tagged_lines(spark, sf_dir), "run-1")
    store = VersionedTable(spark, f"{Scratch(spark).path}/quarantine")
    store.append(held, "run-1", ["failed_rule"])
    return store.read().select(*LINE, "failed_rule", "execution_id")


@query
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_metrics(_tagged_lines(spark, sf_dir))


@query
def dq_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_outcomes(_tagged_lines(spark, sf_dir), LINE_RULES)


@query
def dq_warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARN and FAIL_PIPELINE rules see the rows that earlier QUARANTINE rules left."""
    tagged = quality.tag_violations(table(spark, sf_dir, "lineitem"), WARN_RULES, read_once=True)
    return quality.rule_outcomes(tagged, WARN_RULES)


@query
def dq_all_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = quality.all_failures(table(spark, sf_dir, "lineitem"), EXPRESSION_RULES, read_once=True)
    return every.select(*LINE, "failed_rule")


@query
def dq_independent_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = quality.independent_clean(table(spark, sf_dir, "lineitem"), EXPRESSION_RULES, read_once=True)
    return clean.select(*LINE)


@query
def dq_distinct_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rows of two runs over the same window, each kept once."""
    rows = table(spark, sf_dir, "events").drop("props")
    tagged = quality.tag_violations(rows, [Rule("value_low", "value", "RANGE", "value < 60")])
    twice = quality.quarantine_rows(tagged, "run-1").unionByName(
        quality.quarantine_rows(tagged, "run-2")
    )
    return quality.distinct_quarantine(twice, ["event_id"], "ts")


@query
def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformance.conformance_report(table(spark, sf_dir, "customer"), CUSTOMER_COLUMNS)


@query
def schema_conform_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformance.conform(table(spark, sf_dir, "orders"), ORDER_COLUMNS)


@query
def schema_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nullability and primary key of declared columns as quality rules."""
    rules = conformance.conformance_rules(
        [ColumnSpec(c, "bigint", False, True) for c in PAIR] + [ColumnSpec("l_tax", "double", False)]
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return quality.rule_outcomes(quality.tag_violations(lines, rules, read_once=True), rules)


# -- keyed changes and loads --------------------------------------------------------------------
@query
def dedup_latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(table(spark, sf_dir, "lineitem"), PAIR, ["l_shipdate"])


@query
def classify_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.classify_changes(
        data.orders_target(spark, sf_dir), data.orders_source(spark, sf_dir), ["o_orderkey"]
    )


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.merge_upsert(
        data.orders_target(spark, sf_dir), data.orders_source(spark, sf_dir), ["o_orderkey"]
    )


@query
def merge_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders come in a year older than they are known: those do not overwrite."""
    older = F.when(
        F.col("o_orderstatus") == "P", F.col("o_orderdate") - F.expr("INTERVAL 365 DAYS")
    ).otherwise(F.col("o_orderdate"))
    source = data.orders_source(spark, sf_dir).withColumn("o_orderdate", older)
    return upsert.merge_upsert(
        data.orders_target(spark, sf_dir), source, ["o_orderkey"], newer_than="o_orderdate"
    )


@query
def merge_repeated_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target repeats keys: every one of its matching rows is updated."""
    lines = table(spark, sf_dir, "lineitem").select(*PAIR, "l_suppkey", "l_quantity", "l_shipdate")
    changed = lines.filter("l_linenumber <= 2").withColumn("l_quantity", F.col("l_quantity") + 100)
    source = dedup_latest(changed, PAIR, ["l_shipdate"])
    target = lines.filter((F.col("l_shipdate") < ntz("1999-01-01")) | (F.col("l_linenumber") > 2))
    return upsert.merge_upsert(target, source, PAIR, on_duplicate="trust")


@query
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source repeats keys: its latest row per key counts."""
    lines = table(spark, sf_dir, "lineitem").select(*PAIR, "l_suppkey", "l_quantity", "l_shipdate")
    target = dedup_latest(lines.filter("l_linenumber <= 4"), PAIR, ["l_shipdate"])
    source = lines.filter("l_linenumber >= 4").withColumn("l_quantity", -F.col("l_quantity"))
    return upsert.merge_upsert(
        target, source, PAIR, on_duplicate="latest", latest_by=["l_shipdate"]
    )


def _loaded(spark: SparkSession, sf_dir: str, mode: str, **how) -> DataFrame:
    """Store the target orders, load the source orders by ``mode``, read the table."""
    path = f"{Scratch(spark).path}/orders"
    write_table(data.orders_target(spark, sf_dir), path, "append", batch_id="run-1")
    source = data.orders_source(spark, sf_dir)
    return write_table(source, path, mode, batch_id="run-2", **how).read()


@query
def load_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first write lands as it is, even in merge mode and with repeated keys."""
    lines = table(spark, sf_dir, "lineitem").select(*PAIR, "l_partkey", "l_suppkey")
    path = f"{Scratch(spark).path}/lines"
    return write_table(lines, path, "merge", batch_id="run-1", merge_keys=PAIR).read()


@query
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, "append")


@query
def load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, "overwrite")


@query
def load_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, "merge", merge_keys=["o_orderkey"])


@query
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill of one year: its partition is replaced, the others stay."""
    orders = data.with_year(table(spark, sf_dir, "orders"))
    redone = orders.filter("o_year = 1996 AND o_orderstatus <> 'P'")
    redone = redone.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    path = f"{Scratch(spark).path}/orders"
    write_table(orders, path, "overwrite", batch_id="run-1", partition_cols=["o_year"])
    return write_table(redone, path, "replace_partitions", batch_id="run-2").read()


@query
def merge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge into a table partitioned by a merge key: only touched partitions are rewritten."""
    keys = ["o_orderkey", "o_year"]
    path = f"{Scratch(spark).path}/orders"
    target = data.with_year(data.orders_target(spark, sf_dir))
    source = data.with_year(data.orders_source(spark, sf_dir))
    write_table(target, path, "merge", batch_id="run-1", partition_cols=["o_year"])
    return write_table(source, path, "merge", batch_id="run-2", merge_keys=keys).read()


@query
def update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional update with expressions."""
    rows = data.pipelines(spark, sf_dir)
    values = {"pipeline_name": F.upper("pipeline_name"), "is_active": F.lit(True)}
    return upsert.update_where(rows, "NOT is_active", values)


# -- control and audit --------------------------------------------------------------------------
@query
def resolve_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and target table of every configured load."""
    return reports.source_and_target(
        data.pipelines(spark, sf_dir), data.config_tables(spark, sf_dir)
    )


@query
def active_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = data.config_rules(spark, sf_dir)
    return reports.active_rules(rules, data.rule_owners(spark, sf_dir)).select(
        "rule_id", "table_id", "rule_type", "pipeline_id"
    )


@query
def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_state(data.watermark_log(spark, sf_dir))


@query
def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_runs(data.run_events(spark, sf_dir))


@query
def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.last_success(data.runs(spark, sf_dir))


@query
def sla_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = reports.sla_breaches(data.runs(spark, sf_dir), ntz("2000-01-01"), 86400 * 365)
    return late.select("run_id", "pipeline_id", "status", "breach", "open_seconds")


@query
def dependency_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dependency_ready(data.dependencies(spark, sf_dir), data.runs(spark, sf_dir))


@query
def step_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.step_profile(data.steps(spark, sf_dir))


@query
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reconcile(data.reconciliations(spark, sf_dir))


@query
def discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.discrepancies(reports.reconcile(data.reconciliations(spark, sf_dir)))
    return found.select("pipeline_id", "source_count", "discrepancy_count")


@query
def reconciliation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per market segment of the customers' reconciliations."""
    segment = table(spark, sf_dir, "customer").select(
        data.text("c_custkey").alias("pipeline_id"), F.col("c_mktsegment").alias("segment")
    )
    counts = data.reconciliations(spark, sf_dir).join(segment, "pipeline_id")
    per_segment = counts.drop("pipeline_id").withColumnRenamed("segment", "pipeline_id")
    return reports.running_totals(per_segment)


@query
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = reports.reconcile(data.reconciliations(spark, sf_dir))
    counts = counts.withColumnRenamed("pipeline_id", "run_id")
    return reports.run_report(
        data.runs(spark, sf_dir), data.steps(spark, sf_dir), counts, data.quality_log(spark, sf_dir)
    )


@query
def steps_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.steps_in_order(data.steps(spark, sf_dir))


def _landed_and_held(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events loaded day by day, errors quarantined."""
    rows = table(spark, sf_dir, "events").drop("props")
    rows = rows.withColumn("batch_id", F.date_format("ts", "yyyy-MM-dd"))
    failed = F.col("event_type") == "error"
    held = rows.filter(failed).withColumns(
        {"failed_rule": F.lit("typed"), "execution_id": F.col("batch_id")}
    )
    return rows.filter(~failed), held


@query
def trace_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.trace_batch(*_landed_and_held(spark, sf_dir), "2024-01-15")


@query
def trace_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, held = _landed_and_held(spark, sf_dir)
    file = F.concat(F.col("event_type"), F.lit(".json"))
    return lineage.trace_file(
        landed.withColumn("source_file_name", file),
        held.withColumn("source_file_name", file),
        "error.json",
    )


@query
def ingest_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events loaded at the end of their day."""
    loaded = F.date_trunc("day", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    rows = table(spark, sf_dir, "events").withColumns(
        {"batch_id": F.date_format("ts", "yyyy-MM-dd"), "ingestion_timestamp": loaded}
    )
    return lineage.latency_report(rows, "ts")


# -- whole loads --------------------------------------------------------------------------------
def _store(spark: SparkSession, sf_dir: str, mode: str, target: dict, rules: list[Rule]):
    """Control tables for one load of the events."""
    store = ControlStore(spark, f"{Scratch(spark).path}/root")
    store.initialize()
    begun = datetime(2024, 1, 1)
    store.replace(
        "pipeline_config",
        [{"pipeline_id": "events", "pipeline_name": "Events", "is_active": True, "created_at": begun}],
    )
    common = {"pipeline_id": "events", "write_mode": mode}
    source = {
        "table_id": "src",
        "layer": "landing",
        "table_name": "events",
        "storage_path": data.path(sf_dir, "events"),
        "file_format": "parquet",
    }
    landing = {
        "table_id": "tgt",
        "layer": "bronze",
        "table_name": "events",
        "storage_path": f"{store.root}/bronze/events",
        "file_format": "table",
    }
    store.replace("table_config", [{**common, **source}, {**common, **landing, **target}])
    store.replace(
        "dq_rules",
        [
            {
                "rule_id": r.rule_id,
                "table_id": "tgt",
                "column_name": r.column_name,
                "rule_type": r.rule_type,
                "expression": r.expression,
                "action_on_fail": r.action_on_fail,
                "is_active": True,
            }
            for r in rules
        ],
    )
    store.put_watermark(WatermarkState("w", "events", "tgt", "ts"), begun)
    return store, VersionedTable(spark, landing["storage_path"])


EVENT_RULES = [
    Rule("event_unique", "event_id", "UNIQUE"),
    Rule("type_known", "event_type", "REGEX", "^(view|click|purchase|signup)$"),
    Rule("value_range", "value", "RANGE", "value < 90"),
]
EVENT = ["event_id", "ts", "user_id", "event_type", "value", "batch_id"]


@query
def two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two configured runs in a row: the second one reads what came after the first."""
    store, target = _store(spark, sf_dir, "merge", {"merge_keys": ["event_id"]}, EVENT_RULES)
    for run_id, now in (("run-1", datetime(2024, 1, 15)), ("run-2", datetime(2024, 2, 1))):
        run_incremental(spark, store, "events", now=now, run_id=run_id)
    return target.read().select(*EVENT)


@query
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of two runs, a backfill between them."""
    store, _ = _store(spark, sf_dir, "merge", {"merge_keys": ["event_id"]}, EVENT_RULES)
    run_incremental(spark, store, "events", now=datetime(2024, 1, 15), run_id="run-1")
    store.set_backfill("events", "ACTIVE", datetime(2024, 1, 5), datetime(2024, 1, 8))
    run_incremental(spark, store, "events", now=datetime(2024, 1, 16), run_id="run-2")
    run_incremental(spark, store, "events", now=datetime(2024, 2, 1), run_id="run-3")
    runs = reports.latest_runs(store.read("audit_pipeline_execution"))
    counts = store.read("audit_data_reconciliation").drop("pipeline_id")
    return runs.join(counts, "run_id").select(
        "run_id",
        "status",
        F.col("watermark_start").cast("timestamp_ntz").alias("watermark_start"),
        F.col("watermark_end").cast("timestamp_ntz").alias("watermark_end"),
        "records_read",
        "records_written",
        "target_inserted_count",
        "target_updated_count",
        "quarantine_count",
        "discrepancy_count",
    )


@query
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load fed by a file stream."""
    store, target = _store(spark, sf_dir, "append", {}, EVENT_RULES)
    source = data.path(sf_dir, "events")
    options = LoadOptions()
    if not storage.is_dir(spark, source):
        # a stream watches a folder: narrow it to the one file
        store.update("table_config", "layer = 'landing'", {"storage_path": F.lit(sf_dir)})
        options = LoadOptions(read_options={"pathGlobFilter": "events.parquet"})
    checkpoint = f"{store.root}/stream"
    ingest_available(
        spark, store, "events", schema=data.EVENTS, checkpoint=checkpoint, options=options
    )
    return _without_stream_id(target.read().select(*EVENT))


def _without_stream_id(rows: DataFrame) -> DataFrame:
    """Batch ids without the random id of the stream's checkpoint."""
    return rows.withColumn("batch_id", F.regexp_replace("batch_id", "-[0-9a-f]{12}-", "-"))


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts over with a new checkpoint appends again and replaces nothing."""
    store, target = _store(spark, sf_dir, "append", {}, EVENT_RULES)
    options = LoadOptions()
    if not storage.is_dir(spark, data.path(sf_dir, "events")):
        store.update("table_config", "layer = 'landing'", {"storage_path": F.lit(sf_dir)})
        options = LoadOptions(read_options={"pathGlobFilter": "events.parquet"})
    for k in (1, 2):
        ingest_available(
            spark, store, "events", schema=data.EVENTS, checkpoint=f"{store.root}/stream-{k}", options=options
        )
    return _without_stream_id(target.read().select(*EVENT))


@query
def append_two_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pipelines share the events by type and append to one table."""
    store, target = _store(spark, sf_dir, "append", {}, [])
    more = [{**r.asDict(), "pipeline_id": "rest", "table_id": f"{r.table_id}-rest"} for r in store.read("table_config").collect()]
    store.append("table_config", more, "rest")
    pipeline = store.read("pipeline_config").first().asDict()
    store.append("pipeline_config", [{**pipeline, "pipeline_id": "rest"}], "rest")
    store.put_watermark(WatermarkState("w2", "rest", "tgt-rest", "ts"), datetime(2024, 1, 1))
    seen = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))
    for run_id, pipeline_id, mine in (("run-1", "events", seen), ("run-2", "rest", ~seen)):
        options = LoadOptions(transform=lambda df, mine=mine: df.filter(mine))
        run_incremental(spark, store, pipeline_id, now=datetime(2024, 2, 1), run_id=run_id, options=options)
    return target.read().select(*EVENT)


@query
def time_renderings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written in eight ways and read back as wall-clock times."""
    patterns = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "yyyy-MM-dd HH:mm",
                "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss'-05:30'", "'at noon'")
    way = F.col("event_id") % (len(patterns) + 1)
    seen = F.coalesce(*(F.when(way == k, F.date_format("ts", p)) for k, p in enumerate(patterns)))
    times = table(spark, sf_dir, "events").select("event_id", seen.alias("seen"))
    return times.select("event_id", parse_time(F.col("seen")).alias("moment"))


@query
def schema_enforced_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that casts to declared types and holds back rows that a cast would alter."""
    store, target = _store(spark, sf_dir, "append", {}, [])
    store.update("table_config", "layer = 'landing'", {"storage_path": F.lit(data.path(sf_dir, "lineitem"))})
    declared = {"l_orderkey": "bigint", "l_linenumber": "bigint", "l_quantity": "bigint"}
    store.replace("column_config", [
        {"column_id": str(k), "table_id": "tgt", "column_name": c, "data_type": d, "is_nullable": True, "is_primary_key": False}
        for k, (c, d) in enumerate(declared.items())])
    half = F.when(F.col("l_linenumber") % 3 == 0, 0.5).otherwise(0.0)

    def lines(df: DataFrame) -> DataFrame:
        return df.select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("double") + half).alias("l_quantity"))

    options = LoadOptions(transform=lines, enforce_columns=True)
    run_incremental(spark, store, "events", now=datetime(2024, 2, 1), run_id="run-1", options=options)
    held = store.quarantine("events").read().select("l_orderkey", "l_linenumber", "l_quantity", F.lit(True).alias("held"))
    kept = target.read().select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"), F.lit(False).alias("held"))
    return kept.unionByName(held.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")))


@query
def halted_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of a run that a FAIL_PIPELINE rule stopped."""
    rules = [
        Rule("a_type", "event_type", "REGEX", "^(view|click|purchase)$"),
        Rule("b_value", "value", "RANGE", "value < 90", "FAIL_PIPELINE"),
        Rule("c_user", "user_id", "NOT_NULL"),
    ]
    store, _ = _store(spark, sf_dir, "append", {}, rules)
    try:
        run_incremental(spark, store, "events", now=datetime(2024, 2, 1), run_id="run-1")
    except QualityHalt:
        pass
    runs = store.read("audit_pipeline_execution").filter("status = 'FAILED'").select("run_id")
    return store.read("data_quality_log").join(runs, "run_id").select("run_id", "rule_id", "failed_records", "status")


@query
def silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types and one latest row per key."""
    columns = [
        ColumnSpec("l_orderkey", "bigint"),
        ColumnSpec("l_linenumber", "bigint"),
        ColumnSpec("l_shipdate", "date"),
        ColumnSpec("l_suppkey", "string"),
        ColumnSpec("l_returnflag", "string"),
    ]
    lines = table(spark, sf_dir, "lineitem").select(*(c.column_name for c in columns))
    return conformed_latest(columns, PAIR, "l_shipdate")(lines)


@query
def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary by configured aggregate expressions."""
    measures = {
        "n_lines": "count(*)",
        "n_orders": "count(DISTINCT l_orderkey)",
        "quantity": "sum(CAST(l_quantity AS BIGINT))",
        "last_ship": "max(l_shipdate)",
    }
    return rollup(["l_returnflag", "l_linestatus"], measures)(table(spark, sf_dir, "lineitem"))


@query
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window, quality, merge: the orders after one load."""
    orders = table(spark, sf_dir, "orders")
    target = data.orders_target(spark, sf_dir)
    window = increment.select_increment(
        orders, "o_orderdate", datetime(1997, 7, 1), datetime(2001, 1, 1)
    )
    source = window.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    rules = [
        Rule("price_range", "o_totalprice", "RANGE", "o_totalprice > 1000"),
        Rule("priority_known", "o_orderpriority", "REGEX", "^[1-4]-"),
        Rule("order_unique", "o_orderkey", "UNIQUE"),
    ]
    clean = quality.clean_rows(quality.tag_violations(source, rules))
    return upsert.merge_upsert(target, clean, ["o_orderkey"])

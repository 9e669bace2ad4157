"""One incremental load: extract, check, classify, load, reconcile, advance."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import event_time, instant, latest_time, readable_sql, utc_now
from tidemark.model import ColumnSpec, ConfigError, QualityHalt, Rule, RunContext, Table, WatermarkState
from tidemark.operators.conformance import conform, conformance_rules
from tidemark.operators.increment import Bounds, resolve_bounds, select_increment
from tidemark.operators.lineage import stamp
from tidemark.operators.quality import (
    FAILED_STATUS,
    clean_rows,
    failure_count,
    quarantine_rows,
    tag_violations,
)
from tidemark.operators.upsert import Written
from tidemark.plans.audit import RunLog
from tidemark.plans.control import ControlStore
from tidemark.plans.load import write_table
from tidemark.schemas import BATCH_ID, FAILED_RULE, LOADED_AT, SOURCE_FILE
from tidemark.scratch import Scratch, enough_partitions
from tidemark.sources import storage
from tidemark.sources.files import CORRUPT, ROW_TEXT_FORMATS, csv_schema, read_source
from tidemark.sources.tables import VersionedTable


READABLE = "watermark_readable"  # built-in rule: the row's time is present and readable
WELL_FORMED = "line_well_formed"  # built-in rule: the line the row was read from fits its format
BUILT_IN = (READABLE, WELL_FORMED)


@dataclass(frozen=True)
class LoadOptions:
    """What a run may be told beyond the control tables."""

    schema: T.StructType | str | None = None
    read_options: dict[str, str] = field(default_factory=dict)
    transform: Callable[[DataFrame], DataFrame] | None = None
    on_missing_watermark: str = "full"
    watermark_basis: str = "clean"  # or "read": quarantined rows advance it too
    track_new: bool = True  # create watermark state on the first success of a pipeline without any
    on_duplicate: str = "matched"
    newer_than: str | None = None
    null_keys: str = "insert"
    enforce_columns: bool = False  # check and cast to the declared columns of the target
    stage: bool = True  # False reads an unchanging source again instead of copying its new rows
    rule_order: Sequence[str] = ()  # ids of the rules that come first, in order; the others by id
    changes: bool = False  # a merge also leaves change rows, for summaries that follow its target
    keep_versions: int | None = 2  # of a rewritten target; older ones are deleted after a success


@dataclass(frozen=True)
class RunResult:
    run_id: str | None
    status: str
    records_read: int = 0
    records_clean: int = 0
    quarantined: int = 0
    inserted: int = 0
    updated: int = 0
    skipped: int = 0  # older than the row the target holds, or than another of the batch
    watermark: datetime | None = None
    rule_failures: dict[str, int] = field(default_factory=dict)


class Discrepancy(RuntimeError):
    """Rows that were read are neither stored nor quarantined. The watermark stays where it was."""


@dataclass
class Batch:
    """Staged rows of one run with their tags and counts."""

    tagged: DataFrame
    read: int
    clean: int
    failures: dict[str, int]
    clean_top: datetime | None
    read_top: datetime | None

    @property
    def quarantined(self) -> int:
        return self.read - self.clean


def check_batch(
    rows: DataFrame, rules: Sequence[Rule], scratch: Scratch, watermark_col: str | None
) -> Batch:
    """Tag staged rows and take every count of the run in one aggregate."""
    tagged = tag_violations(rows, rules, scratch, write=True)
    ok = F.col(FAILED_RULE).isNull()
    aggs = [F.count(F.lit(1)).alias("read"), F.count_if(ok).alias("clean")]
    aggs += [failure_count(r).alias(f"rule_{i}") for i, r in enumerate(rules)]
    if watermark_col in rows.columns:
        moment = event_time(rows, watermark_col)
        tops = {"clean_top": F.when(ok, moment), "read_top": moment}
        aggs += [latest_time(rows, watermark_col, t).alias(name) for name, t in tops.items()]
    row = tagged.agg(*aggs).first().asDict()
    return Batch(
        tagged,
        row["read"],
        row["clean"],
        {r.rule_id: row[f"rule_{i}"] for i, r in enumerate(rules)},
        row.get("clean_top"),
        row.get("read_top"),
    )


def apply_actions(
    batch: Batch, rules: Sequence[Rule], store: ControlStore, pipeline_id: str, log: RunLog
) -> int:
    """Log every rule, quarantine failed rows, and stop at a FAIL_PIPELINE rule that caught any.
    Rows of the rules before that one are still quarantined; nothing of it or after it is. Returns the
    rows counted while they were written."""
    table = store.quarantine(pipeline_id)
    written = 0
    halt: Rule | None = None
    held: list[str] = []
    for rule in rules:
        failed = batch.failures[rule.rule_id]
        if failed == 0:
            if rule.rule_id not in BUILT_IN:
                log.rule(rule.rule_id, 0, "PASSED")
            continue
        path = None
        if rule.action_on_fail == "QUARANTINE":
            held.append(rule.rule_id)
            path = f"{table.path} ({FAILED_RULE}={rule.rule_id})"
        log.rule(rule.rule_id, failed, FAILED_STATUS[rule.action_on_fail], path)
        if rule.action_on_fail == "FAIL_PIPELINE":
            halt = rule
            break
    if held:
        rows = without_casts(quarantine_rows(batch.tagged, log.ctx.run_id))
        if not batch.failures.get(WELL_FORMED):
            rows = rows.drop(CORRUPT)
        if halt is not None:
            rows = rows.filter(F.col(FAILED_RULE).isin(held))
        written = table.append(rows, log.ctx.run_id, [FAILED_RULE], allow_new_columns=True)
    if halt is not None:
        raise QualityHalt(halt.rule_id, batch.failures[halt.rule_id])
    return written


def load_batch(clean: DataFrame, target: Table, segment: str, scratch: Scratch, options: LoadOptions) -> Written:
    """Write the clean rows; returns what the stored table took. A row is updated when its key met a target
    row, and skipped when that was newer or the batch holds a later row of the key. A key that the
    target holds twice counts twice, so that the run does not reconcile."""
    keys = list(target.merge_keys)
    merge: dict = {}
    if target.write_mode == "merge" and keys:
        merge = {
            "scratch": scratch,
            "on_duplicate": options.on_duplicate,
            "latest_by": [options.newer_than] if options.newer_than else None,
            "newer_than": options.newer_than,
            "null_keys": options.null_keys,
            "changes": options.changes,
        }
    existed = VersionedTable(clean.sparkSession, target.storage_path).exists()
    table = write_table(
        clean,
        target.storage_path,
        target.write_mode,
        batch_id=segment,
        merge_keys=keys,
        partition_cols=list(target.partition_cols),
        **merge,
    )
    stored = getattr(table, "written", None) or Written()
    if merge and existed and options.on_duplicate == "latest":
        keyed = clean.select(*keys).dropna()
        later = keyed.count() - keyed.distinct().count()
        stored = replace(stored, skipped=stored.skipped + later)
    return stored


def run_incremental(
    spark: SparkSession,
    store: ControlStore,
    pipeline_id: str,
    *,
    now: datetime | None = None,
    run_id: str | None = None,
    environment: str = "dev",
    watermark_col: str = "last_updated_at",
    options: LoadOptions | None = None,
) -> RunResult:
    """Run a configured pipeline once. The source is read a single time and staged; every later
    stage works on the staged rows, so that counts and writes agree even if files keep arriving."""
    options = options or LoadOptions()
    now = now or utc_now()
    job = open_job(spark, store, pipeline_id, now, run_id, environment, watermark_col, options)
    if job is None:
        return RunResult(None, "SKIPPED")
    with job.guard():
        with job.log.step("extract") as step:
            staged = extract(job)
            if options.stage:
                staged, n_read = counted_table(job.scratch, staged)
            else:
                n_read = staged.count()
            step["records"] = n_read
            if n_read and job.parents is not None:
                log_parents(job)
        stored = storage.size(spark, job.scratch.path)
        stored += job.table.stored_bytes
        with enough_partitions(spark, stored):
            return process(job, staged, n_read)


def counted_table(scratch: Scratch, df: DataFrame) -> tuple[DataFrame, int]:
    """A scratch table and its rows, counted in its files."""
    table = scratch.table(df)
    return table, table.count()


@dataclass
class Job:
    """Everything one run needs."""

    spark: SparkSession
    store: ControlStore
    pipeline_id: str
    source: Table
    target: Table
    rules: list[Rule]
    columns: list[ColumnSpec]
    state: WatermarkState | None
    bounds: Bounds
    column: str
    ctx: RunContext
    log: RunLog
    scratch: Scratch
    options: LoadOptions
    parents: DataFrame | None = None  # runs that the rows of a table source came from
    segment: str | None = None  # name of the rows in an appended table, the run id by default

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.target.storage_path)

    @contextmanager
    def guard(self):
        """Close the run as FAILED on an error, and drop its staged rows in any case."""
        try:
            yield
        except Exception as error:
            self.log.close("FAILED", error=str(error))
            raise
        finally:
            self.scratch.drop()


def open_job(
    spark: SparkSession,
    store: ControlStore,
    pipeline_id: str,
    now: datetime,
    run_id: str | None,
    environment: str,
    watermark_col: str,
    options: LoadOptions,
) -> Job | None:
    """Resolve configuration and bounds and open the run; None for an inactive pipeline."""
    store.initialize()
    pipeline = store.pipeline(pipeline_id)
    if not pipeline.is_active:
        return None
    whole = getattr(options.transform, "needs_all_rows", False)
    with ThreadPoolExecutor(2) as pool:  # small lookups that do not depend on each other
        watermark = pool.submit(store.watermark, pipeline_id)
        tables = store.tables(pipeline_id)
        source, target = store.ends(pipeline_id, tables)
        found = pool.submit(store.rules_of, tables)
        columns = store.columns(target.table_id) if options.enforce_columns else []
        rules = in_order(found.result(), options.rule_order)
        state = watermark.result()
    if whole and target.write_mode != "overwrite":
        raise ConfigError("a rollup of an increment is no summary: overwrite with all rows, or append a Summary's partials")
    bounds = resolve_bounds(state, now)
    ids = {"run_id": run_id} if run_id else {}
    ctx = RunContext(
        pipeline.pipeline_name, environment, execution_time=now, watermark=bounds.start, **ids
    )
    scratch = Scratch(spark)  # fails, if it does, before the run is noted as running
    log = RunLog(store, pipeline_id, ctx)
    log.open()
    return Job(
        spark,
        store,
        pipeline_id,
        source,
        target,
        rules,
        columns,
        state,
        bounds,
        state.watermark_column if state else watermark_col,
        ctx,
        log,
        scratch,
        options,
    )


def in_order(rules: list[Rule], first: Sequence[str]) -> list[Rule]:
    """Rules by the given order of their ids, those it does not name after them by id. The order decides
    which rule a row with several failures counts for."""
    place = {rule_id: k for k, rule_id in enumerate(first)}
    return sorted(rules, key=lambda r: (place.get(r.rule_id, len(place)), r.rule_id))


CAST = "__cast_"


def without_casts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(CAST)])


def prepared(job: Job, staged: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """Staged rows and the rules of the run. Before the configured rules stand those for malformed lines,
    whose text is kept in quarantine unless the run's transform drops it, for rows whose time cannot be
    read and, with enforced columns, for declared types, nulls and the key; the key is
    checked on cast values, in columns beside the original ones."""
    rules: list[Rule] = []
    if CORRUPT in staged.columns:
        rules.append(Rule(WELL_FORMED, CORRUPT, "EXPRESSION", f"{CORRUPT} IS NULL"))
    if job.column in staged.columns and (job.bounds.start or job.bounds.end):
        rules.append(Rule(READABLE, job.column, "EXPRESSION", readable_sql(staged, job.column)))
    if job.columns:
        have = {f.name: f.dataType for f in staged.schema.fields}
        for rule in conformance_rules(job.columns, castable=True, have=have):
            if rule.rule_type == "UNIQUE":
                kinds = {c.column_name: c.data_type for c in job.columns}
                casts = {f"{CAST}{c}": F.col(f"`{c}`").try_cast(kinds[c]) for c in rule.columns if c in have}
                staged = staged.withColumns(casts)
                rule = replace(rule, column_name=",".join(f"{CAST}{c}" if c in have else c for c in rule.columns))
            rules.append(rule)
    return staged, rules + job.rules


def extract(job: Job) -> DataFrame:
    """The new rows of the source, stamped and transformed."""
    options = job.options
    schema = options.schema
    if schema is None and job.source.file_format.lower() in ROW_TEXT_FORMATS:
        # declared columns of the source spare the pass that infers a schema
        declared = job.store.columns(job.source.table_id)
        if declared and job.source.file_format.lower() == "csv":
            schema = csv_schema(
                job.spark, job.source.storage_path, options.read_options, {c.column_name: c.data_type for c in declared}
            )
        elif declared:
            schema = ", ".join(f"`{c.column_name}` {c.data_type}" for c in declared)
    df = read_source(
        job.spark,
        job.source.storage_path,
        job.source.file_format,
        schema=schema,
        options=options.read_options,
        keep_corrupt=True,
    )
    if job.column in df.columns and (job.state is not None or options.track_new):
        job.segment = window_name(job)
    df = select_increment(
        df,
        job.column,
        job.bounds.start,
        job.bounds.end,
        on_missing=options.on_missing_watermark,
        keep_unreadable=True,  # to be quarantined and counted
    )
    if job.source.file_format.lower() == "table" and BATCH_ID in df.columns:
        job.parents = df.select(F.col(BATCH_ID).alias("parent_run_id")).dropna().distinct()
    return transformed(job, stamp_rows(job, df))


def log_parents(job: Job) -> None:
    """Note from which runs this one's rows came; as many rows as these are, never on the driver."""
    rows = job.parents.select(F.lit(job.ctx.run_id).alias("run_id"), "parent_run_id")
    job.store.table("audit_run_parents").append(rows.coalesce(1), job.ctx.run_id, counted=False)


def window_name(job: Job) -> str:
    """Segment of a run: its pipeline and the watermark state it started from. A run that crashed before
    it wrote a new state is repeated from the same one and replaces its segment; a run that
    finished has always written one, so the next run never shares its name."""
    state = job.state.updated_at.isoformat() if job.state and job.state.updated_at else "begin"
    return f"{job.pipeline_id}-from-{state}"


def stamp_rows(job: Job, df: DataFrame) -> DataFrame:
    from_table = job.source.file_format.lower() == "table"
    return stamp(df, job.ctx.run_id, job.ctx.execution_time, keep_file=from_table)


def transformed(job: Job, df: DataFrame) -> DataFrame:
    """Apply the transform of the run; stamps it drops, as a grouping does, are put back."""
    if job.options.transform is None:
        return df
    out = job.options.transform(df)
    stamps = {
        LOADED_AT: instant(job.ctx.execution_time),
        SOURCE_FILE: F.lit(job.source.storage_path),
        BATCH_ID: F.lit(job.ctx.run_id),
    }
    return out.withColumns({c: v for c, v in stamps.items() if c not in out.columns})


def conformed(job: Job, clean: DataFrame) -> DataFrame:
    return conform(clean, job.columns, keep_extra=True) if job.columns else clean


def process(job: Job, staged: DataFrame, n_read: int) -> RunResult:
    """Check, load, reconcile and advance on staged rows, and close the run."""
    store, log, bounds, ctx = job.store, job.log, job.bounds, job.ctx
    if n_read == 0:
        log.reconcile(0, 0, 0, 0, "No source rows in the window.")
        if bounds.is_backfill:
            store.set_backfill(job.pipeline_id, "COMPLETED")
        mark = bounds.end if bounds.is_backfill else bounds.start
        log.close("SUCCESS", mark, 0, 0)
        return RunResult(ctx.run_id, "SUCCESS", watermark=mark)

    with log.step("dq_checks") as step:
        staged, rules = prepared(job, staged)
        batch = check_batch(staged, rules, job.scratch, job.column)
        quarantined = apply_actions(batch, rules, store, job.pipeline_id, log)
        step["records"] = batch.clean

    with log.step("target_load") as step:
        stored = load_batch(
            conformed(job, without_casts(clean_rows(batch.tagged)).drop(CORRUPT)),
            job.target,
            job.segment or ctx.run_id,
            job.scratch,
            job.options,
        )
        step["records"] = stored.inserted + stored.updated

    note = (
        f"{n_read} rows read: {stored.inserted} inserted, {stored.updated} updated,"
        f" {quarantined} held."
    )
    if stored.skipped:
        note += f" {stored.skipped} skipped as older."
    if bounds.is_backfill:
        note += " Backfill."
    gap = log.reconcile(n_read, stored.inserted, stored.updated, quarantined, note, stored.skipped)
    if gap:
        raise Discrepancy(f"{gap} of {n_read} rows read are neither stored nor quarantined")

    mark = advance(job, batch)
    if job.options.keep_versions is not None:
        job.table.expire(job.options.keep_versions)
    log.close("SUCCESS", mark, n_read, stored.inserted + stored.updated)
    return RunResult(
        ctx.run_id,
        "SUCCESS",
        n_read,
        batch.clean,
        quarantined,
        stored.inserted,
        stored.updated,
        stored.skipped,
        mark,
        {k: n for k, n in batch.failures.items() if n or k not in BUILT_IN},
    )


def advance(job: Job, batch: Batch) -> datetime | None:
    """Move the control state on. A batch without a usable time, or with late rows only, keeps the
    old watermark: it never jumps to the clock and never moves back. A backfill completes and leaves
    the watermark alone."""
    state, bounds, store = job.state, job.bounds, job.store
    top = batch.read_top if job.options.watermark_basis == "read" else batch.clean_top
    if bounds.is_backfill:
        store.set_backfill(job.pipeline_id, "COMPLETED")
        return top or bounds.end
    known = [t for t in (top, state.last_watermark_value if state else None) if t is not None]
    mark = max(known, default=None)
    if state is not None:
        store.advance_watermark(job.pipeline_id, mark)
    elif job.options.track_new and job.segment is not None:  # also without a mark: see window_name
        store.put_watermark(
            WatermarkState(
                f"{job.pipeline_id}_watermark",
                job.pipeline_id,
                job.target.table_id,
                job.column,
                mark,
            )
        )
    return mark

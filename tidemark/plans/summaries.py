"""Stored summaries that grow with increments and follow the changes of their base table."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import summary
from tidemark.operators.skew import lookup_join
from tidemark.operators.summary import ORDER, RESET, RETRACTABLE, Measure
from tidemark.scratch import Scratch, measure
from tidemark.sources.tables import VersionedTable

_UP_TO = re.compile(r"upto-(\d+)$")


class Summary:
    """A table of states under ``path``, either of appended increments (``add``) or of the changes of a base
    table (``refresh``). An increment is a segment: one that is repeated after a crash replaces itself
    and is never counted twice. ``prepare`` derives the columns to group by and to measure."""

    def __init__(
        self, spark: SparkSession, path: str, group_by: Sequence[str], measures: Sequence[Measure],
        prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    ):
        if not group_by:
            raise ValueError("a summary needs columns to group by")
        self.spark, self.group_by, self.measures, self.prepare = spark, list(group_by), list(measures), prepare
        self.table = VersionedTable(spark, path)

    # -- increments -----------------------------------------------------------------------------
    def partials(self, df: DataFrame) -> DataFrame:
        """State rows of an increment: the transform of a run that appends to the summary's table."""
        states = summary.partial_states(self.prepare(df), self.group_by, self.measures)
        return states.withColumns({ORDER: F.lit(0).cast("long"), RESET: F.lit(False)})

    def add(self, df: DataFrame, batch_id: str) -> None:
        """Take in rows that no earlier increment held. The same ``batch_id`` again replaces them."""
        self.table.append(self.partials(df), batch_id, counted=False)

    # -- changes of a base table ----------------------------------------------------------------
    @property
    def up_to(self) -> int | None:
        """Number of the last change of the base table that is taken in; None before the first refresh."""
        found = [_UP_TO.search(s) for s in self.table.segments] if self.table.exists() else []
        return max((int(m[1]) for m in found if m), default=None)

    def refresh(self, base: VersionedTable, scratch: Scratch | None = None) -> None:
        """Follow ``base`` from where the last refresh stood: counts and sums by its change rows, groups of
        other measures that lost a row by reading their rows again. The first time reads it whole. Not
        while ``base`` is being written."""
        scratch = scratch or Scratch(self.spark)
        last, newest = self.up_to, base.last_change
        if last is None:
            states = self.partials(base.read()).withColumn(ORDER, F.lit(newest).cast("long"))
            self.table.overwrite(states, f"upto-{newest}", counted=False)
            return
        if newest == last:
            return
        rows = self.prepare(summary.signed_rows(base.changes(after=last)))
        states = summary.signed_states(rows, self.group_by, self.measures).withColumn(RESET, F.lit(False))
        if any(m.kind not in RETRACTABLE for m in self.measures):
            rows = scratch.table(rows)
            states = summary.signed_states(rows, self.group_by, self.measures).withColumn(RESET, F.lit(False))
            lost = scratch.table(rows.filter(F.col(summary.SIGN) < 0).select(*self.group_by).distinct())
            size = measure(lost)
            if size[0]:
                again = lookup_join(self.prepare(base.read()), lost, self.group_by, "left_semi", size=size, null_safe=True)
                whole = summary.partial_states(again, self.group_by, self.measures).withColumn(RESET, F.lit(True))
                # a group without any row left is reset to nothing
                gone = lookup_join(lost, whole.select(*self.group_by), self.group_by, "left_anti", null_safe=True)
                nothing = gone.withColumns({summary.ROWS: F.lit(0).cast("long"), RESET: F.lit(True)})
                kept = lookup_join(states, lost, self.group_by, "left_anti", size=size, null_safe=True)
                states = kept.unionByName(whole).unionByName(nothing, allowMissingColumns=True)
        states = states.withColumn(ORDER, F.lit(newest).cast("long"))
        self.table.append(states.select(*self.table.schema.names), f"upto-{newest}", counted=False)

    # -- reading --------------------------------------------------------------------------------
    def states(self) -> DataFrame:
        """Stored states that count."""
        states = self.table.read()
        return summary.since_reset(states, self.group_by) if self._resets() else states

    def _resets(self) -> bool:
        return any(m.kind not in RETRACTABLE for m in self.measures) and self.up_to is not None

    def read(self) -> DataFrame:
        """The summary, from the states alone."""
        return summary.results(self.states(), self.group_by, self.measures)

    def read_by(self, group_by: Sequence[str]) -> DataFrame:
        """The summary over fewer columns: states of several groups merge like those of several increments."""
        return summary.results(self.states(), list(group_by), self.measures)

    def fold(self) -> None:
        """Merge all states of a group into one. Not while an increment may still be repeated."""
        last = self.up_to
        folded = summary.merged_states(self.states(), self.group_by, self.measures)
        folded = folded.withColumns({ORDER: F.lit(last or 0).cast("long"), RESET: F.lit(False)})
        name = "folded" if last is None else f"upto-{last}"
        self.table.overwrite(folded.select(*self.table.schema.names), name, counted=False)


def step_profiles(spark: SparkSession, path: str) -> Summary:
    """Durations of steps (rows of the step audit) per step and day, for profiles over any span of days that
    never read old audit rows again."""
    seconds = "timestampdiff(SECOND, start_time, end_time)"
    measures = [
        Measure("n_steps", "count"),
        Measure("n_failed", "count", "CASE WHEN status = 'FAILED' THEN 1 END"),
        Measure("total_seconds", "sum", seconds),
        Measure("max_seconds", "max", seconds),
        Measure("p50", "quantile", seconds, 0.5),
        Measure("p95", "quantile", seconds, 0.95),
    ]
    return Summary(
        spark, path, ["step_name", "day"], measures, lambda steps: steps.withColumn("day", F.to_date("start_time"))
    )

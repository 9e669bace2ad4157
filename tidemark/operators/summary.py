"""Summaries as mergeable states: partial aggregates that are added up instead of computed again.

A state row holds, for one group and one increment, what each measure needs to go on: numbers for counts
and sums, extremes, HLL sketches for distinct counts and KLL sketches for quantiles. Counts and sums also
take retracted rows back; the other measures cannot, and their groups are computed anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import lookup_join
from tidemark.scratch import measure as measured

ROWS = "_rows"  # rows of a group, less those retracted
ORDER = "_order"  # place of the increment; states before a reset of their group no longer count
RESET = "_reset"
SIGN = "_sign"
# Kinds of measures.
KINDS = ("count", "sum", "avg", "min", "max", "distinct", "quantile")
RETRACTABLE = ("count", "sum", "avg")


@dataclass(frozen=True)
class Measure:
    """``kind`` of the SQL expression ``value``. ``at`` is the share of a quantile, whose values are doubles
    and whose rank may be off by some two hundredths; distinct counts are off by some two hundredths
    beyond a few hundred values. Sums of doubles depend on the order of increments: cast to decimals."""

    name: str
    kind: str
    value: str = "1"
    at: float = 0.5

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind of measure '{self.kind}'")

    @property
    def columns(self) -> list[str]:
        return [f"{self.name}__sum", f"{self.name}__n"] if self.kind in ("sum", "avg") else [f"{self.name}__{self.kind}"]

    def partial(self, sign: Column) -> list[Column]:
        """Aggregates over rows, each counted ``sign`` times."""
        value = F.expr(self.value)
        known = F.sum(F.when(value.isNotNull(), sign).otherwise(0)).cast("long")
        if self.kind == "count":
            made = [known]
        elif self.kind in ("sum", "avg"):
            made = [F.sum(F.when(sign < 0, -value).otherwise(value)), known]
        elif self.kind in ("min", "max"):
            made = [getattr(F, self.kind)(value)]
        elif self.kind == "distinct":
            made = [F.expr(f"hll_sketch_agg({self.value})")]
        else:
            made = [F.expr(f"kll_sketch_agg_double(CAST({self.value} AS DOUBLE))")]
        return [c.alias(name) for c, name in zip(made, self.columns)]

    def merged(self) -> list[Column]:
        """Aggregates over states."""
        first = self.columns[0]
        if self.kind in ("count", "sum", "avg"):
            made = [F.sum(c) for c in self.columns]
        elif self.kind in ("min", "max"):
            made = [getattr(F, self.kind)(first)]
        elif self.kind == "distinct":
            made = [F.expr(f"hll_union_agg(`{first}`)")]
        else:
            made = [F.expr(f"kll_merge_agg_double(`{first}`)")]
        return [c.alias(name) for c, name in zip(made, self.columns)]

    def result(self) -> Column:
        """The measure's value from its merged state."""
        first = self.columns[0]
        if self.kind in ("sum", "avg"):
            total, n = (F.col(c) for c in self.columns)
            out = F.when(n > 0, total if self.kind == "sum" else total / n)
        elif self.kind == "distinct":
            out = F.coalesce(F.expr(f"hll_sketch_estimate(`{first}`)"), F.lit(0).cast("long"))
        elif self.kind == "quantile":
            seen = F.expr(f"kll_sketch_get_n_double(`{first}`)") > 0
            out = F.when(seen, F.expr(f"kll_sketch_get_quantile_double(`{first}`, {self.at}D)"))
        else:
            out = F.col(first)
        return out.alias(self.name)


def partial_states(df: DataFrame, group_by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One state row per group of ``df``."""
    one = F.lit(1)
    states = [c for m in measures for c in m.partial(one)]
    return df.groupBy(*group_by).agg(F.count(one).alias(ROWS), *states)


def signed_states(rows: DataFrame, group_by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """State rows of changed rows with ``SIGN`` -1 for what goes and 1 for what comes. The states of
    measures that cannot be retracted hold what comes only."""
    sign = F.col(SIGN)
    comes = [c for m in measures if m.kind not in RETRACTABLE for c in m.partial(F.lit(1))]
    totals = rows.groupBy(*group_by).agg(
        F.sum(SIGN).cast("long").alias(ROWS), *[c for m in measures if m.kind in RETRACTABLE for c in m.partial(sign)]
    )
    if not comes:
        return totals
    added = rows.filter(sign > 0).groupBy(*group_by).agg(*comes)
    same = [F.col(f"t.`{c}`").eqNullSafe(F.col(f"a.`{c}`")) for c in group_by]
    rest = [f"a.`{c}`" for c in added.columns if c not in group_by]
    return totals.alias("t").join(added.alias("a"), same, "left").select("t.*", *rest)


def merged_states(states: DataFrame, group_by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One state row per group from any number of them."""
    return states.groupBy(*group_by).agg(F.sum(ROWS).alias(ROWS), *[c for m in measures for c in m.merged()])


def since_reset(states: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """States that still count. Resets are few beside states and meet them by group."""
    resets = states.filter(RESET).groupBy(*group_by).agg(F.max(ORDER).alias("_since"))
    joined = lookup_join(states, resets, list(group_by), "left", size=measured(resets), null_safe=True)
    return joined.filter(F.col("_since").isNull() | (F.col(ORDER) >= F.col("_since"))).drop("_since")


def results(states: DataFrame, group_by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The summary: groups that still have rows, and their measures."""
    merged = merged_states(states, group_by, measures)
    return merged.filter(F.col(ROWS) > 0).select(*group_by, *[m.result() for m in measures])


def signed_rows(changes: DataFrame) -> DataFrame:
    """What goes (-1) and what comes (1) of change rows (``before`` and ``after``, either null)."""
    images = F.array(
        F.struct(F.lit(-1).alias(SIGN), F.col("before").alias("row")), F.struct(F.lit(1).alias(SIGN), F.col("after").alias("row"))
    )
    return changes.select(F.explode(images).alias("x")).filter("x.row IS NOT NULL").select(f"x.{SIGN}", "x.row.*")

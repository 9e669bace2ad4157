"""Rule-driven data quality.

Rules run in sequence on the rows that survived the QUARANTINE rules before them, but nothing is
filtered step by step: one plan tags every row with the first rule it fails, and clean rows,
quarantined rows and all counts are read off the tags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import ConfigError, Rule
from tidemark.operators.keys import dedup_latest, repeated_keys
from tidemark.operators.skew import MAX_HOT_KEYS, fits_broadcast, hot_rows, lookup_join
from tidemark.schemas import EXECUTION_ID, FAILED_RULE
from tidemark.scratch import Scratch, measure

WARNED = "warned_rules"
_AT = "__failed_at"
_MARK = "__repeated"


def fails(rule: Rule) -> Column:
    """TRUE where a row violates a row-level rule, FALSE elsewhere, never NULL: a predicate that is
    NULL counts as a failure, and so does a null in the checked column."""
    if rule.rule_type == "NOT_NULL":
        return F.col(rule.column_name).isNull()
    if rule.rule_type == "REGEX":
        return ~F.coalesce(F.col(rule.column_name).rlike(rule.expression), F.lit(False))
    failed = ~F.coalesce(F.expr(rule.expression), F.lit(False))
    if rule.rule_type == "EXPRESSION":
        return failed
    if rule.rule_type in ("RANGE", "MIN_VAL"):
        return failed | F.col(rule.column_name).isNull()
    raise ValueError(f"rule '{rule.rule_id}' ({rule.rule_type}) is not a row-level rule")


def mark_repeated(
    df: DataFrame, keys: list[str], into: str, scratch: Scratch, alive: Column | None = None, *, write_many: bool = True
) -> DataFrame:
    """Add boolean ``into``: the row is alive and shares its key with another alive row.

    The repeated keys are computed first, from the key columns alone, and written down. None: no join
    at all. Few: a broadcast join, the rows do not move. Many: a shuffle join beside the hot keys, whose
    result is written down, unless the caller does that or reads it only once.
    """
    alive = F.lit(True) if alive is None else alive
    keyed = scratch.table(repeated_keys(df.filter(alive), keys))
    size = measure(keyed)
    if size[0] == 0:
        return df.withColumn(into, F.lit(False))
    lookup = keyed.select(*keys, F.lit(True).alias(_MARK))
    if fits_broadcast(df.sparkSession, size):
        joined = lookup_join(df, lookup, keys, size=size, null_safe=True)
    else:
        top = keyed.filter(F.col("n") >= hot_rows(df.sparkSession)).orderBy(F.desc("n"))
        hot = [r[0] for r in top.limit(MAX_HOT_KEYS).select(F.xxhash64(*keys)).collect()]
        joined = lookup_join(df, lookup, keys, hot=hot, null_safe=True)
        if write_many:  # once, because clean rows, quarantined rows and counts all read it
            joined = scratch.table(joined)
    return joined.withColumn(into, alive & F.col(_MARK).isNotNull()).drop(_MARK)


def _last_unique(rules: Sequence[Rule]) -> int | None:
    return max((i for i, r in enumerate(rules) if r.rule_type == "UNIQUE"), default=None)


def tag_violations(
    df: DataFrame, rules: Sequence[Rule], scratch: Scratch | None = None, *, write: bool = False, read_once: bool = False
) -> DataFrame:
    """Add ``failed_rule`` (first failed QUARANTINE rule or null) and ``warned_rules`` (WARN and
    FAIL_PIPELINE rules that a row violates while no earlier QUARANTINE rule has removed it). With ``write``
    the tagged rows are written down if tagging them takes a join, so that it is made once for all who
    read them; rows without a failed rule lie apart. With ``read_once`` the last join is not written, so that
    only the columns that the one reader wants take part in it."""
    if len({r.rule_id for r in rules}) < len(rules):
        raise ConfigError("rule ids repeat")
    scratch = scratch or Scratch(df.sparkSession)
    last = _last_unique(rules)
    tagged = df.withColumn(_AT, F.lit(None).cast("int"))
    pending: list[Column] = []
    flags: list[tuple[int, Rule, Column]] = []
    marks: list[str] = []

    def settle(frame: DataFrame) -> DataFrame:
        out = frame.withColumn(_AT, F.coalesce(F.col(_AT), *pending)) if pending else frame
        pending.clear()
        return out

    for i, rule in enumerate(rules):
        if rule.rule_type == "UNIQUE":
            tagged = settle(tagged)
            mark = f"__mark_{i}"
            marks.append(mark)
            many = not write and not (read_once and i == last)  # the next key is looked for in this result
            tagged = mark_repeated(tagged, rule.columns, mark, scratch, F.col(_AT).isNull(), write_many=many)
            failed = F.col(mark)
        else:
            failed = fails(rule)
        if rule.action_on_fail == "QUARANTINE":
            pending.append(F.when(failed, F.lit(i)))
        else:
            flags.append((i, rule, failed))
    tagged = settle(tagged)

    ids = F.array(*(F.lit(r.rule_id) for r in rules)) if rules else F.array(F.lit(""))
    here = F.coalesce(F.col(_AT), F.lit(len(rules)))
    warned = [F.when(failed & (here > i), F.lit(rule.rule_id)) for i, rule, failed in flags]
    warned_col = F.array_compact(F.array(*warned)) if warned else F.array().cast("array<string>")
    # get(), not element_at(): with a literal array, element_at() returns a value for a null index
    failed_rule = F.get(ids, F.col(_AT))
    tagged = tagged.withColumns({FAILED_RULE: failed_rule, WARNED: warned_col}).drop(_AT, *marks)
    return scratch.table(tagged, [FAILED_RULE]) if write and marks else tagged


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(FAILED_RULE).isNull()).drop(FAILED_RULE, WARNED)


def quarantine_rows(tagged: DataFrame, execution_id: str) -> DataFrame:
    """Failed rows, each once, stamped with the rule and the run."""
    held = tagged.filter(F.col(FAILED_RULE).isNotNull()).drop(WARNED)
    return held.withColumn(EXECUTION_ID, F.lit(execution_id))


def distinct_quarantine(quarantine: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per (keys, time, rule): rows read again by later runs are quarantined again."""
    return dedup_latest(quarantine, [*keys, column, FAILED_RULE], [EXECUTION_ID])


def failure_count(rule: Rule) -> Column:
    """Aggregate over a tagged frame: rows the rule caught."""
    if rule.action_on_fail == "QUARANTINE":
        return F.count_if(F.col(FAILED_RULE) == rule.rule_id)
    return F.count_if(F.array_contains(WARNED, rule.rule_id))


# Status of a rule that caught rows, by action.
FAILED_STATUS = {
    "QUARANTINE": "FAILED_QUARANTINED",
    "WARN": "FAILED_WARN",
    "FAIL_PIPELINE": "FAILED_HALTED",
}


def rule_outcomes(tagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: failed rows and status, from a single aggregate."""
    counts = tagged.agg(*(failure_count(r).alias(f"n{i}") for i, r in enumerate(rules)))
    rows = []
    for i, r in enumerate(rules):
        n = F.col(f"n{i}")
        status = F.when(n > 0, FAILED_STATUS[r.action_on_fail]).otherwise("PASSED")
        rows.append(
            F.struct(
                F.lit(i).alias("rule_order"),
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.action_on_fail).alias("action_on_fail"),
                n.alias("failed_records"),
                status.alias("status"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def quality_metrics(tagged: DataFrame) -> DataFrame:
    """One row: rows read, passed, quarantined and warned about."""
    return tagged.agg(
        F.count(F.lit(1)).alias("read_count"),
        F.count_if(F.col(FAILED_RULE).isNull()).alias("passed_count"),
        F.count_if(F.col(FAILED_RULE).isNotNull()).alias("failed_count"),
        F.count_if(F.size(WARNED) > 0).alias("warned_count"),
    )


def failed_rules(
    df: DataFrame, rules: Sequence[Rule], scratch: Scratch | None = None, into: str = "failed_rules", *, read_once: bool = False
) -> DataFrame:
    """Add the array of all rules a row violates, each judged on the whole input. ``read_once`` as in
    ``tag_violations``."""
    scratch = scratch or Scratch(df.sparkSession)
    last = _last_unique(rules)
    tests: list[Column] = []
    marks: list[str] = []
    for i, rule in enumerate(rules):
        if rule.rule_type == "UNIQUE":
            marks.append(f"__mark_{i}")
            df = mark_repeated(df, rule.columns, marks[-1], scratch, write_many=not (read_once and i == last))
            tests.append(F.when(F.col(marks[-1]), F.lit(rule.rule_id)))
        else:
            tests.append(F.when(fails(rule), F.lit(rule.rule_id)))
    return df.withColumn(into, F.array_compact(F.array(*tests))).drop(*marks)


def all_failures(
    df: DataFrame, rules: Sequence[Rule], scratch: Scratch | None = None, *, read_once: bool = False
) -> DataFrame:
    """One row per (row, violated rule): rules are independent and a row may fail several."""
    every = failed_rules(df, rules, scratch, "__every", read_once=read_once)
    return every.withColumn(FAILED_RULE, F.explode("__every")).drop("__every")


def independent_clean(
    df: DataFrame, rules: Sequence[Rule], scratch: Scratch | None = None, *, read_once: bool = False
) -> DataFrame:
    """Rows that no QUARANTINE rule rejects when every rule is judged on the whole input."""
    acting = [r for r in rules if r.action_on_fail == "QUARANTINE"]
    if not acting:
        return df
    return failed_rules(df, acting, scratch, "__every", read_once=read_once).filter(F.size("__every") == 0).drop("__every")

"""Conformance of a frame to declared columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ColumnSpec, Rule
from tidemark.operators.keys import repeated_keys


def declared_type(name: str) -> T.DataType:
    return T.DataType.fromDDL(name)


def conform(
    df: DataFrame, columns: Sequence[ColumnSpec], *, keep_extra: bool = False
) -> DataFrame:
    """Declared columns in declared order and type. A value that does not cast becomes null, and so
    does a missing column; the not-null rules then catch what may not be null."""
    out: list[Column] = []
    for c in columns:
        kind = declared_type(c.data_type)
        found = c.column_name in df.columns
        value = F.col(c.column_name).try_cast(kind) if found else F.lit(None).cast(kind)
        out.append(value.alias(c.column_name))
    if keep_extra:
        declared = {c.column_name for c in columns}
        out += [F.col(c) for c in df.columns if c not in declared]
    return df.select(*out)


def lossless_sql(name: str, to: str, have: T.DataType | None) -> str:
    """SQL predicate: a value that is not null casts to the declared type and, unless it is text, back
    to itself, so that no fraction, time of day or digit is lost."""
    cast = f"try_cast(`{name}` AS {to})"
    if have is None or isinstance(have, T.StringType) or have == declared_type(to):
        return f"{cast} IS NOT NULL"
    return f"{cast} IS NOT NULL AND try_cast({cast} AS {have.simpleString()}) <=> `{name}`"


def conformance_rules(
    columns: Sequence[ColumnSpec],
    action: str = "QUARANTINE",
    *,
    castable: bool = False,
    have: dict[str, T.DataType] | None = None,
) -> list[Rule]:
    """Nullability and primary key as quality rules, preceded on request by rules that catch values
    ``conform`` would turn into nulls or, given the types at hand (``have``), alter."""
    rules = []
    if castable:
        for c in columns:
            if have is not None and c.column_name not in have:
                continue
            cast = lossless_sql(c.column_name, c.data_type, (have or {}).get(c.column_name))
            test = f"`{c.column_name}` IS NULL OR ({cast})"
            rules.append(Rule(f"{c.column_name}_castable", c.column_name, "EXPRESSION", test, action))
    rules += [
        Rule(f"{c.column_name}_not_null", c.column_name, "NOT_NULL", "", action)
        for c in columns
        if not c.is_nullable or c.is_primary_key
    ]
    key = [c.column_name for c in columns if c.is_primary_key]
    if key:
        rules.append(Rule("primary_key", ",".join(key), "UNIQUE", "", action))
    return rules


def conformance_report(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """One row per declared column and check, with the number of rows that violate it: ``present``,
    ``type`` (declared type differs), ``castable``, ``not_null``, and ``unique`` for the key."""
    have = {f.name: f.dataType for f in df.schema.fields}
    checks: list[tuple[str, str, Column]] = []
    everything, nothing = F.count(F.lit(1)), F.count_if(F.lit(False))
    for c in columns:
        name, kind = c.column_name, declared_type(c.data_type)
        if name not in have:
            checks.append((name, "present", everything))
            continue
        value = F.col(name)
        checks.append((name, "present", nothing))
        checks.append((name, "type", nothing if have[name] == kind else everything))
        lost = value.isNotNull() & ~F.expr(lossless_sql(name, c.data_type, have[name]))
        checks.append((name, "castable", F.count_if(lost)))
        if not c.is_nullable:
            checks.append((name, "not_null", F.count_if(value.isNull())))
    row = df.agg(*(agg.alias(f"n{i}") for i, (_, _, agg) in enumerate(checks)))

    def entry(name: str, check: str, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(check).alias("check_name"),
            n.cast("long").alias("violations"),
        )

    report = row.select(
        F.inline(F.array(*(entry(n, k, F.col(f"n{i}")) for i, (n, k, _) in enumerate(checks))))
    )
    key = [c.column_name for c in columns if c.is_primary_key and c.column_name in have]
    if key:
        twice = repeated_keys(df, key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        report = report.unionByName(
            twice.select(F.inline(F.array(entry(",".join(key), "unique", F.col("n")))))
        )
    return report

"""Keyed changes: insert/update classification, merge and conditional update."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import dedup_latest, repeated_keys
from tidemark.operators.skew import fits_broadcast, lookup_join
from tidemark.scratch import Scratch, bytes_of, measure
from tidemark.sources.tables import VersionedTable, align

_NEW = "__new"
_SEEN = "__seen"


class RepeatedKeys(ValueError):
    """A merge source holds a key more than once."""


def _has_keys(keys: list[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def matched_keys(
    target: DataFrame, source: DataFrame, keys: list[str], scratch: Scratch
) -> DataFrame:
    """Distinct keys that occur on both sides, written down. Only key columns are read; a small
    source is broadcast so that the target does not move, otherwise both sides are reduced to their
    distinct keys before they meet."""
    wanted = scratch.table(source.select(*keys).filter(_has_keys(keys)).distinct())
    held = target.select(*keys)
    if fits_broadcast(target.sparkSession, measure(wanted)):
        hits = held.join(F.broadcast(wanted), keys, "left_semi").distinct()
    else:
        hits = held.distinct().join(wanted, keys, "left_semi")
    return scratch.table(hits)


def classify_changes(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One row: source rows whose key is new to the target, and the rest. Null keys are new. Both
    sides are reduced to their keys before the join, so it carries one row per key."""
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    known = target.select(*keys).distinct().withColumn(_SEEN, F.lit(True))
    n, seen = F.col("n"), F.col(_SEEN).isNotNull()

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("long")

    return counted.join(known, keys, "left").agg(
        total(n).alias("source_count"),
        total(F.when(~seen, n)).alias("inserted_count"),
        total(F.when(seen, n)).alias("updated_count"),
    )


def _not_older(new: Column, old: Column) -> Column:
    return F.coalesce(new >= old, old.isNull())


_BEFORE = "__before"
_TIMES = "__times"


def located_keys(
    target: DataFrame, source: DataFrame, keys: list[str], parts: list[str], newer_than: str | None, scratch: Scratch
) -> DataFrame:
    """One written row per key that occurs on both sides and partition that holds it: the ``parts``, how
    many target rows it has there (``n``), how many of these are newer than the source's (``newer``), and how
    many source rows (``times``).
    Of the target only these columns are read, once; a small source is broadcast so that it does not
    move, otherwise it is grouped before it meets the source's keys."""
    latest = F.max(newer_than) if newer_than else F.lit(0)
    wanted = source.filter(_has_keys(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(_TIMES), latest.alias(_NEW))
    wanted = scratch.table(wanted)
    places = [*keys, *(p for p in parts if p not in keys)]
    old = F.col(newer_than) if newer_than else F.lit(0)
    held = target.select(*places, old.alias(_SEEN))
    one = F.lit(1).cast("long").alias("n")
    if fits_broadcast(target.sparkSession, measure(wanted)):
        met = held.withColumn("n", one).join(F.broadcast(wanted), keys)
    else:
        met = held.groupBy(*places, _SEEN).agg(F.count(F.lit(1)).alias("n")).join(wanted, keys)
    newer = F.when(~_not_older(F.col(_NEW), F.col(_SEEN)), F.col("n")).otherwise(0)
    counts = [F.sum("n").alias("n"), F.sum(newer).alias("newer"), F.max(_TIMES).alias("times")]
    return scratch.table(met.groupBy(*places).agg(*counts))


def located_rows(
    target: DataFrame, source: DataFrame, keys: list[str], parts: list[str], columns: list[str], newer_than: str | None, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """As ``located_keys``, and the target rows themselves with their keys, written in the same pass."""
    latest = F.max(newer_than) if newer_than else F.lit(0)
    wanted = source.filter(_has_keys(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(_TIMES), latest.alias(_NEW))
    wanted = scratch.table(wanted)
    places = [*keys, *(p for p in parts if p not in keys)]
    held = target.select(*places, F.struct(*columns).alias(_BEFORE))
    rows = scratch.table(lookup_join(held, wanted, keys, "inner", size=measure(wanted)))
    old = F.col(f"{_BEFORE}.{newer_than}") if newer_than else F.lit(0)
    newer = F.when(~_not_older(F.col(_NEW), old), 1).otherwise(0)
    counts = [F.count(F.lit(1)).alias("n"), F.sum(newer).cast("long").alias("newer"), F.max(_TIMES).alias("times")]
    return scratch.table(rows.groupBy(*places).agg(*counts)), rows.select(*places, _BEFORE)


def change_rows(
    before: DataFrame, source: DataFrame, matched: DataFrame, keys: list[str], columns: list[str], newer_than: str | None
) -> DataFrame:
    """``before`` and ``after`` of every row that a merge changes: of the target rows that take another source
    row, and of the source rows with new keys. ``source`` has one row per matched key."""
    size = measure(matched)
    image = source.select(*keys, F.struct(*columns).alias("after"))
    met = before.join(image, keys).withColumnRenamed(_BEFORE, "before")
    if newer_than:
        met = met.filter(_not_older(F.col(f"after.{newer_than}"), F.col(f"before.{newer_than}")))
    updated = met.filter(~F.col("before").eqNullSafe(F.col("after"))).select("before", "after")
    added = lookup_join(image, matched, keys, "left_anti", size=size)
    nothing = F.lit(None).cast(before.schema[_BEFORE].dataType).alias("before")
    return updated.unionByName(added.select(nothing, "after"))


def _one_row_per_key(
    source: DataFrame,
    matched: DataFrame,
    keys: list[str],
    on_duplicate: str,
    latest_by: list[str] | None,
) -> DataFrame:
    if on_duplicate == "trust":
        return source
    keyed = source.filter(_has_keys(keys))
    if on_duplicate == "latest":
        if not latest_by:
            raise ValueError("on_duplicate='latest' needs latest_by")
        return dedup_latest(keyed, keys, latest_by).unionByName(source.filter(~_has_keys(keys)))
    repeated = repeated_keys(keyed, keys)
    if on_duplicate == "matched":
        repeated = repeated.join(matched, keys, "left_semi")
    elif on_duplicate != "error":
        raise ValueError(f"unknown on_duplicate '{on_duplicate}'")
    found = repeated.take(1)
    if found:
        sample = {k: found[0][k] for k in keys}
        raise RepeatedKeys(f"merge source repeats keys, such as {sample} ({found[0]['n']} rows)")
    return source


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    scratch: Scratch | None = None,
    *,
    on_duplicate: str = "matched",
    latest_by: list[str] | None = None,
    newer_than: str | None = None,
    null_keys: str = "insert",
    matched: DataFrame | None = None,
) -> DataFrame:
    """The target after a merge: rows whose key is in ``source`` take the source row, all other
    target rows stay, source rows with new keys are added. Null keys match nothing.

    - ``on_duplicate``: a key repeated in ``source`` fails when the target holds it ("matched"), in
      any case ("error"), or is reduced to its latest row ("latest"); "trust" skips the check.
    - ``newer_than``: keep target rows whose value in this column is greater than the source's.
    - ``null_keys``: "insert" or "reject" source rows with a null key.
    - ``matched``: the result of ``matched_keys``, when the caller has it already.
    """
    if matched is None:
        scratch = scratch or Scratch(target.sparkSession)
        matched = matched_keys(target, align(source, target.schema), keys, scratch)
    kept, inserts, _ = _merge_parts(
        target,
        source,
        keys,
        matched,
        on_duplicate=on_duplicate,
        latest_by=latest_by,
        newer_than=newer_than,
        null_keys=null_keys,
    )
    return kept.unionByName(inserts)


def _merge_parts(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    matched: DataFrame,
    *,
    on_duplicate: str = "matched",
    latest_by: list[str] | None = None,
    newer_than: str | None = None,
    null_keys: str = "insert",
    size: tuple[int, int] | None = None,
) -> tuple[DataFrame, DataFrame, bool]:
    """Target rows after the update, rows to add, and whether the target rows stayed in place."""
    source = align(source, target.schema)
    if null_keys == "reject" and source.filter(~_has_keys(keys)).take(1):
        raise ValueError(f"merge source has null values in the keys {keys}")
    size = size or measure(matched)
    source = _one_row_per_key(source, matched, keys, on_duplicate, latest_by)
    if size[0] == 0:
        return target, source, True

    inserts = lookup_join(source, matched, keys, "left_anti", size=size)
    if fits_broadcast(target.sparkSession, size):
        updates = lookup_join(source, matched, keys, "left_semi", size=size)
        updates_size = measure(updates)
    else:
        # rows with other keys meet no target row anyhow: shuffling for them once is enough
        updates, updates_size = source.filter(_has_keys(keys)), None
    lookup = updates.select(*keys, F.struct(*target.columns).alias(_NEW))
    met = lookup_join(target, lookup, keys, "left", size=updates_size)
    take = F.col(_NEW).isNotNull()
    if newer_than is not None:
        take = take & _not_older(F.col(f"{_NEW}.{newer_than}"), F.col(newer_than))
    kept_or_new = [
        F.col(c) if c in keys else F.when(take, F.col(f"{_NEW}.{c}")).otherwise(F.col(c)).alias(c)
        for c in target.columns
    ]
    return met.select(*kept_or_new), inserts, fits_broadcast(target.sparkSession, updates_size)


def in_partitions(target: DataFrame, touched: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of the touched partitions. The join on partition columns alone prunes the scan to these (an
    equality join does, a null-safe one would not; partitions of nulls are filtered instead)."""
    size = measure(touched)
    known = F.lit(True)
    for p in parts:
        known = known & F.col(p).isNotNull()
    # the comparison tells the optimizer that the small side is worth pruning by
    whole = touched.filter(known & (F.col(_SEEN) > 0)).select(*parts)
    found = lookup_join(target, whole, parts, "left_semi", size=size)
    nulls = touched.filter(~known).select(*parts)
    if nulls.take(1):
        rest = lookup_join(target.filter(~known), nulls, parts, "left_semi", size=size, null_safe=True)
        found = found.unionByName(rest)
    return found


@dataclass(frozen=True)
class Written:
    """Rows that a load stored, counted in the stored table."""

    inserted: int = 0
    updated: int = 0
    skipped: int = 0  # met a newer target row


def merge_into(
    table: VersionedTable,
    source: DataFrame,
    keys: list[str],
    batch_id: str,
    scratch: Scratch | None = None,
    *,
    changes: bool = False,
    **options,
) -> Written:
    """Merge ``source`` into a stored table. Of a table with partitions, or with buckets of the keys, only
    those that change are read and replaced; otherwise the whole table is rewritten as a new version.
    Partitions that follow from the keys are read only where the source has rows for them.

    ``inserted`` is what the table gained by the merge, counted in its files before and after; ``updated``
    and ``skipped`` count target rows that took, or were newer than, their source row. With ``changes`` the
    table also gets the images before and after of every row that changes, one more write of these rows.
    """
    scratch = scratch or Scratch(table.spark)
    layout = table.layout
    folders = layout.folders
    target = table.read_stored()
    source = layout.placed(align(source, layout.schema))
    follows = set(layout.partition_cols) <= set(keys) and set(layout.bucket_keys) <= set(keys)
    if changes and not folders:
        raise ValueError("change rows need a table with partitions or buckets")
    touched = None
    if folders:
        touched = scratch.table(source.select(*folders).distinct().withColumn(_SEEN, F.lit(1)))
    if folders and follows:
        target = in_partitions(target, touched, folders)
    newer_than = options.get("newer_than")
    images = None
    if changes:
        located, images = located_rows(target, source, keys, folders, layout.schema.names, newer_than, scratch)
    else:
        located = located_keys(target, source, keys, folders, newer_than, scratch)
    found = [F.sum("n"), F.sum("newer"), F.max("times"), F.count(F.lit(1)), F.sum(bytes_of(located.select(*keys)))]
    met, newer, times, *size = (x or 0 for x in located.agg(*found).first())
    matched = located.select(*keys).distinct()
    on_duplicate = options.get("on_duplicate", "matched")
    if on_duplicate == "matched" and times < 2:
        on_duplicate = "trust"  # no key that the target holds is repeated
    options |= {"on_duplicate": on_duplicate, "size": tuple(size)}
    if folders and not follows:
        losing = located.select(*folders).distinct().withColumn(_SEEN, F.lit(1))
        touched = scratch.table(touched.union(losing).distinct())
        target = in_partitions(target, touched, folders)
    before = target.count()
    if changes:
        choice = options.pop("on_duplicate", "matched"), options.pop("latest_by", None)
        source, options["on_duplicate"] = _one_row_per_key(source, matched, keys, *choice), "trust"
        images = change_rows(images, source, matched, keys, layout.schema.names, newer_than)
    kept, inserts, in_place = _merge_parts(target, source, keys, matched, **options)
    if in_place and folders:
        # rows read from a partition go back to it: only the added ones need to be gathered
        inserts = inserts.hint("rebalance", *folders)
    merged = kept.unionByName(inserts)
    if folders:
        table.replace_partitions(merged, batch_id, touched=touched, clustered=in_place, changes=images)
        after = in_partitions(table.read_stored(), touched, folders).count()
    else:
        after = table.overwrite(merged, batch_id, clustered=in_place)
    return Written(after - before, met - newer, newer)


def update_where(df: DataFrame, condition: str | Column, values: dict[str, Column]) -> DataFrame:
    """Set columns to expressions on the rows that meet ``condition``; a NULL condition is no match."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumns({c: F.when(test, v).otherwise(F.col(c)) for c, v in values.items()})

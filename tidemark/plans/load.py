"""Loading a frame into a stored table by write mode."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from tidemark.operators.upsert import Written, merge_into
from tidemark.sources.tables import VersionedTable


_BUCKETS = re.compile(r"bucket\((\d+)\)")


def folder_columns(declared: list[str]) -> tuple[list[str], int]:
    """Partition columns of a declaration, and the number of buckets that an entry ``bucket(n)`` asks for."""
    found = [_BUCKETS.fullmatch(c.replace(" ", "")) for c in declared]
    numbers = [int(m[1]) for m in found if m]
    if len(numbers) > 1 or 0 in numbers:
        raise ValueError(f"one bucket(n) with n above 0 at most, not {declared}")
    return [c for c, m in zip(declared, found) if not m], sum(numbers)


def write_table(
    df: DataFrame,
    path: str,
    mode: str,
    *,
    batch_id: str,
    merge_keys: list[str] | None = None,
    partition_cols: list[str] | None = None,
    **merge_options,
) -> VersionedTable:
    """Load ``df`` by mode; ``written`` of the returned table says what was stored. A table that does not
    exist yet takes the frame as it is. Among the partition columns may be one ``bucket(n)``: the table
    is then laid out in n buckets of the merge keys, of which a merge replaces only those it changes."""
    table = VersionedTable(df.sparkSession, path)
    parts, n_buckets = folder_columns(partition_cols or [])
    buckets = (n_buckets, list(merge_keys or [])) if n_buckets else None
    if n_buckets and not merge_keys:
        raise ValueError("bucket(n) needs merge keys")
    if mode == "append" and (table.exists() or not n_buckets):
        n = table.append(df, batch_id, parts)
    elif not table.exists():
        n = table.overwrite(df, batch_id, parts, buckets=buckets)
    elif mode == "overwrite":
        n = table.overwrite(df, batch_id, None if partition_cols is None else parts, buckets=buckets)
    elif mode == "replace_partitions":
        n = table.replace_partitions(df, batch_id)
    elif mode == "merge":
        if not merge_keys:
            raise ValueError("merge mode needs merge keys")
        table.written = merge_into(table, df, merge_keys, batch_id, **merge_options)
        return table
    else:
        raise ValueError(f"unsupported write mode '{mode}'")
    table.written = Written(inserted=n)
    return table

"""Parquet tables that are replaced as a whole and appended to in segments.

Layout: ``<table>/v=<n>/seg=<batch>/[<partition>=<value>/]*.parquet``. A segment counts once Spark's
own commit has left its ``_SUCCESS`` file, a version once its first segment counts, and readers take
the highest version that counts. Writing a batch again replaces its segment, so retries never
duplicate rows. One writer per table at a time; there is no transaction log.

Partitions are replaced by a swap: the new ones are written beside the segments, a note names the list
of folders they replace, then the old folders go, the new ones move in and the note is removed. Whoever
opens the table next finishes a swap that was cut short.

Change rows that come with a swap (the images of a row before and after) move in with it, as numbered
folders ``<table>/_changes/c=<n>``: they are there if and only if the swap is.

A table may be laid out in buckets of its keys, a partition column ``_bucket`` that readers do not see:
a merge then reads and replaces only the buckets of its keys. Rows written are counted in the files that
hold them, never by accumulators, which count the rows of a repeated task twice.
"""

from __future__ import annotations

import json
import uuid
from contextlib import nullcontext
from dataclasses import dataclass, replace
from datetime import datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import as_utc
from tidemark.operators.skew import lookup_join
from tidemark.scratch import measure, small_sorts
from tidemark.sources import storage

MERGED = "base-merged"  # segment of partitions that were replaced
BUCKET = "_bucket"
_SWAP = "_swap.json"
_FOLD = "_fold.json"
FOLD_BYTES = 64 << 20
SEGMENTS_AT_ONCE = 500  # that one fold takes together


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


@dataclass(frozen=True)
class Layout:
    """Columns of a table, those its folders are named by, and its buckets (0: none) with their keys."""

    schema: T.StructType
    partition_cols: tuple[str, ...] = ()
    buckets: int = 0
    bucket_keys: tuple[str, ...] = ()

    def __post_init__(self):
        if self.buckets and (not self.bucket_keys or BUCKET in self.schema.names):
            raise ValueError(f"buckets need keys, and a table without a column '{BUCKET}'")

    @property
    def folders(self) -> list[str]:
        return [*self.partition_cols, BUCKET] if self.buckets else list(self.partition_cols)

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())]) if self.buckets else self.schema

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the bucket of each row, and with empty text in partition columns as null, which is what
        a folder name makes of it."""
        texts = [c for c in self.partition_cols if isinstance(df.schema[c].dataType, T.StringType)]
        df = df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in texts}) if texts else df
        if self.buckets and BUCKET not in df.columns:
            hashed = F.xxhash64(*[F.col(f"`{k}`") for k in self.bucket_keys])
            df = df.withColumn(BUCKET, F.pmod(hashed, F.lit(self.buckets)).cast("int"))
        return df


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.written = None  # counts of the load that returned this object

    # -- state ------------------------------------------------------------------------------
    def _committed(self) -> tuple[str | None, list[str]]:
        for note in storage.glob(self.spark, f"{self.path}/v=*/{_SWAP}"):
            self._finish_swap(note.rsplit("/", 1)[0])
        for note in storage.glob(self.spark, f"{self.path}/v=*/{_FOLD}"):
            self._finish_fold(note.rsplit("/", 1)[0])
        done = storage.glob(self.spark, f"{self.path}/v=*/seg=*/_SUCCESS")
        segments = [d.rsplit("/", 1)[0] for d in done]
        if not segments:
            return None, []
        version = max(s.rsplit("/", 1)[0] for s in segments)
        return version, [s for s in segments if s.rsplit("/", 1)[0] == version]

    def exists(self) -> bool:
        return self._committed()[0] is not None

    @property
    def version(self) -> int:
        current = self._committed()[0]
        return int(current.rsplit("=", 1)[1]) if current else 0

    def _layout(self, version: str) -> Layout:
        saved = json.loads(storage.read_text(self.spark, f"{version}/_layout.json"))
        return Layout(
            T.StructType.fromJson(saved["schema"]),
            tuple(saved["partition_cols"]),
            saved.get("buckets", 0),
            tuple(saved.get("bucket_keys", ())),
        )

    @property
    def segments(self) -> list[str]:
        """Batches of the current version, by their names."""
        return [unquote(s.rsplit("/seg=", 1)[1]) for s in self._committed()[1]]

    @property
    def segment_count(self) -> int:
        return len(self._committed()[1])

    @property
    def stored_bytes(self) -> int:
        """Size of the current version on disk."""
        version = self._committed()[0]
        return storage.size(self.spark, version) if version else 0

    @property
    def layout(self) -> Layout:
        return self._layout(self._require()[0])

    @property
    def schema(self) -> T.StructType:
        return self.layout.schema

    @property
    def partition_cols(self) -> list[str]:
        return list(self.layout.partition_cols)

    def _require(self) -> tuple[str, list[str]]:
        version, segments = self._committed()
        if version is None:
            raise FileNotFoundError(f"no committed version under {self.path}")
        return version, segments

    def read(self) -> DataFrame:
        """The current version. A frame read earlier stays valid until that version is expired."""
        return self._current(lambda layout: layout.schema)

    def read_stored(self) -> DataFrame:
        """The current version with its bucket column, if it has one."""
        return self._current(lambda layout: layout.stored)

    def _current(self, shown) -> DataFrame:
        version, segments = self._require()
        layout = self._layout(version)
        return self._files(layout.stored, version, segments).select(*shown(layout).names)

    def _files(self, schema: T.StructType, base: str, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    # -- writes -----------------------------------------------------------------------------
    def _begin(self, layout: Layout) -> str:
        """Folder of the next version, its layout noted; it does not count before a segment does."""
        version = f"{self.path}/v={self.version + 1:08d}"
        self._put_layout(version, layout)
        return version

    def _put_layout(self, version: str, layout: Layout) -> None:
        saved = {"schema": _nullable(layout.schema).jsonValue(), "partition_cols": list(layout.partition_cols)}
        if layout.buckets:
            saved |= {"buckets": layout.buckets, "bucket_keys": list(layout.bucket_keys)}
        storage.write_text(self.spark, f"{version}/_layout.json", json.dumps(saved))

    def create(self, schema: T.StructType, partition_cols: list[str] | None = None) -> None:
        """An empty table, unless there is one already."""
        if not self.exists():
            version = self._begin(Layout(schema, tuple(partition_cols or ())))
            storage.write_text(self.spark, f"{self._segment(version, 'init')}/_SUCCESS", "")

    def _write(self, df: DataFrame, path: str, layout: Layout, clustered: bool = False) -> None:
        """Write a segment."""
        df, folders = layout.placed(df), layout.folders
        if folders and not clustered:
            # AQE splits the hot partitions and packs the small ones
            df = df.hint("rebalance", *folders)
        if layout.buckets:
            df = df.sortWithinPartitions(*folders, *layout.bucket_keys)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if folders:
            writer = writer.partitionBy(*folders)
        with small_sorts(self.spark) if folders else nullcontext():
            writer.parquet(path)
        if not storage.exists(self.spark, f"{path}/_SUCCESS"):
            raise RuntimeError(
                "no _SUCCESS file after the write: tables need"
                " mapreduce.fileoutputcommitter.marksuccessfuljobs"
            )

    def _rows(self, path: str, layout: Layout) -> int:
        """Rows in the files of a segment, which hold their number at their ends."""
        return self._files(layout.stored, path, [path]).count()

    def _segment(self, version: str, batch_id: str) -> str:
        return f"{version}/seg={quote(batch_id, safe='')}"

    def overwrite(
        self,
        df: DataFrame,
        batch_id: str,
        partition_cols: list[str] | None = None,
        *,
        buckets: tuple[int, list[str]] | None = None,
        clustered: bool = False,
        counted: bool = True,
    ) -> int:
        """Publish ``df`` as the next version; returns its rows (0 unless ``counted``). It may be derived from
        the current one. ``buckets`` is their number and keys. Without ``partition_cols`` the layout stays.
        ``clustered`` says that its rows lie together by partition already."""
        current = self._committed()[0]
        if partition_cols is None and current:
            layout = replace(self._layout(current), schema=df.schema)
        else:
            n, keys = buckets or (0, [])
            layout = Layout(df.schema, tuple(partition_cols or ()), n, tuple(keys))
        # named apart from appended batches: a repeated append must never replace the whole table
        path = self._segment(self._begin(layout), f"base-{batch_id}")
        self._write(df, path, layout, clustered=clustered)
        return self._rows(path, layout) if counted else 0

    def append(
        self,
        df: DataFrame,
        batch_id: str,
        partition_cols: list[str] | None = None,
        *,
        allow_new_columns: bool = False,
        counted: bool = True,
    ) -> int:
        """Add one batch and return its rows (0 unless ``counted``). The same ``batch_id`` again replaces what
        it wrote before. ``allow_new_columns`` widens the table's layout; a column whose type has changed
        is then kept as text in a column of its own, ``<name>_as_text``."""
        version, _ = self._committed()
        if version is None:
            version = self._begin(Layout(df.schema, tuple(partition_cols or ())))
        layout = self._layout(version)
        if allow_new_columns:
            df = _drifted(df, layout.schema)
            added = [f for f in df.schema.fields if f.name not in layout.schema.names]
            if added:  # files without a column read as nulls: only the layout has to change
                wider = T.StructType([*layout.schema.fields, *_nullable(T.StructType(added)).fields])
                layout = replace(layout, schema=wider)
                self._put_layout(version, layout)
        path = self._segment(version, batch_id)
        self._write(align(df, layout.schema, fill_missing=allow_new_columns), path, layout)
        return self._rows(path, layout) if counted else 0

    def replace_partitions(
        self,
        df: DataFrame,
        batch_id: str,
        *,
        touched: DataFrame | None = None,
        clustered: bool = False,
        changes: DataFrame | None = None,
    ) -> int:
        """Replace the partitions that occur in ``df``, and those in ``touched`` (the partition columns),
        and leave all others alone; returns the rows written. ``df`` may read the table itself, and so
        may the change rows ``changes`` (before, after)."""
        version, segments = self._require()
        layout = self._layout(version)
        folders = layout.folders
        if not folders:
            raise ValueError(f"table {self.path} has no partition columns")
        df = align(layout.placed(df), layout.stored)
        label = f"{quote(batch_id, safe='')}-{uuid.uuid4()}"
        pending, old = f"{version}/_pending-{label}", f"{version}/_replaced-{label}"
        self._write(df, pending, layout, clustered=clustered)
        gained = self._files(layout.stored, pending, [pending])
        changed = gained.select(*folders).distinct()
        if touched is not None:
            changed = changed.union(touched.select(*folders)).distinct()
        held = self._files(layout.stored, version, segments)
        held = held.select(*folders, F.col("_metadata.file_path").alias("file"))
        replaced = lookup_join(held, changed, folders, "left_semi", size=measure(changed), null_safe=True)
        # file names are encoded as URIs, in which a plus sign stands for itself
        folder = F.regexp_replace(F.regexp_replace("file", "/[^/]*$", ""), r"\+", "%2B")
        replaced.select(F.url_decode(folder).alias("folder")).distinct().write.parquet(old)
        note = {"pending": pending, "depth": len(folders), "old": old, "moving": False}
        if changes is not None:
            note["changes"] = {"from": f"{version}/_changed-{label}", "to": f"{self.path}/_changes/c={self.last_change + 1:08d}"}
            changes.write.parquet(note["changes"]["from"])
        storage.write_text(self.spark, f"{version}/{_SWAP}", json.dumps(note))
        n = gained.count()
        self._finish_swap(version)
        return n

    @property
    def last_change(self) -> int:
        """Number of the latest change that left change rows, 0 without any."""
        self._committed()
        found = storage.glob(self.spark, f"{self.path}/_changes/c=*")
        return int(found[-1].rsplit("=", 1)[1]) if found else 0

    def changes(self, after: int = 0) -> DataFrame:
        """Change rows (before, after, and ``change``, the number) of the changes after number ``after``."""
        image = _nullable(self.schema)
        schema = T.StructType().add("before", image).add("after", image)
        found = [f for f in storage.glob(self.spark, f"{self.path}/_changes/c=*") if int(f.rsplit("=", 1)[1]) > after]
        if not found:
            return self.spark.createDataFrame([], schema.add("change", "integer"))
        files = self._files(schema.add("c", "integer"), f"{self.path}/_changes", found)
        return files.withColumnRenamed("c", "change")

    def forget_changes(self, up_to: int) -> None:
        """Delete the change rows up to a number, once all who follow the table have taken them in. The last
        ones stay, for the numbers to go on."""
        found = storage.glob(self.spark, f"{self.path}/_changes/c=*")
        storage.delete_all(self.spark, [f for f in found[:-1] if int(f.rsplit("=", 1)[1]) <= up_to])

    def _old_folders(self, note: dict, merged: str) -> list[str] | None:
        """Folders that an earlier form of the note lists itself, as URIs. New ones that took the place of
        some may already stand in ``merged``."""
        if isinstance(note["old"], str):
            return None
        folders = [storage.plain_path(self.spark, f) for f in note["old"]]
        return [f for f in folders if not (note["moving"] and f"/{merged.rsplit('/', 1)[1]}/" in f)]

    def _finish_swap(self, version: str) -> None:
        """Carry out the noted swap from wherever it stands; doing any part of it again is harmless."""
        path = f"{version}/{_SWAP}"
        note = json.loads(storage.read_text(self.spark, path))
        merged = self._segment(version, MERGED)
        listed = self._old_folders(note, merged)
        if listed is not None:
            storage.delete_all(self.spark, listed)
        elif not note["moving"]:
            old = self.spark.read.schema("folder string").parquet(note["old"])
            storage.delete_all(self.spark, (r.folder for r in old.toLocalIterator()))
        if not note["moving"]:
            note["moving"] = True  # from here on the old places are free for the new folders
            storage.write_text(self.spark, path, json.dumps(note))
        pattern = "/".join(["*=*"] * note["depth"])
        for folder in storage.glob(self.spark, f"{note['pending']}/{pattern}"):
            inner = "/".join(folder.rsplit("/", note["depth"])[1:])
            storage.move(self.spark, folder, f"{merged}/{inner}")
        storage.write_text(self.spark, f"{merged}/_SUCCESS", "")
        if "changes" in note:
            storage.move(self.spark, note["changes"]["from"], note["changes"]["to"])
        storage.delete(self.spark, note["pending"])
        if listed is None:
            storage.delete(self.spark, note["old"])
        storage.delete(self.spark, path)

    def fold_segments(self, before: datetime) -> int:
        """Make one segment of those finished before a time (UTC), and leave the later ones and whatever is being
        appended alone; returns how many went into others. Not for batches that may still be repeated:
        they are no longer apart. A fold is a noted swap like that of partitions."""
        limit, folded = as_utc(before).timestamp(), 0
        while True:
            version, segments = self._committed()
            if version is None:
                return folded
            old = [s for s in segments if storage.modified(self.spark, f"{s}/_SUCCESS") < limit]
            # large ones stay as they are: a fold gathers small files
            old = [s for s in old if storage.size(self.spark, s) < FOLD_BYTES][:SEGMENTS_AT_ONCE]
            if len(old) < 2:
                return folded
            layout = self._layout(version)
            pending = f"{version}/_pending-fold-{uuid.uuid4()}"
            rows = self._files(layout.stored, version, old)
            if not layout.folders:
                stored = sum(storage.size(self.spark, s) for s in old)
                rows = rows.coalesce(max(1, stored // FOLD_BYTES))
            self._write(rows, pending, layout)
            to = self._segment(version, f"folded-{uuid.uuid4()}")
            note = {"pending": pending, "to": to, "old": old}
            storage.write_text(self.spark, f"{version}/{_FOLD}", json.dumps(note))
            self._finish_fold(version)
            folded += len(old) - 1

    def _finish_fold(self, version: str) -> None:
        path = f"{version}/{_FOLD}"
        note = json.loads(storage.read_text(self.spark, path))
        storage.delete_all(self.spark, note["old"])
        storage.move(self.spark, note["pending"], note["to"])
        storage.delete(self.spark, path)

    def compact(self) -> None:
        """Rewrite the current version as one segment. Not while a run may still be repeated: its
        batch is no longer apart then."""
        self.overwrite(self.read(), str(uuid.uuid4()))

    def expire(self, keep: int = 2) -> None:
        """Delete all but the ``keep`` newest versions."""
        current = self.version
        for path in storage.glob(self.spark, f"{self.path}/v=*"):
            if int(path.rsplit("=", 1)[1]) <= current - keep:
                storage.delete(self.spark, path)


# Types whose every value another type holds exactly.
_EXACT = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


def _widens(have: T.DataType, want: T.DataType) -> bool:
    return want.simpleString() in _EXACT.get(have.simpleString(), ())


def _drifted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with each column that neither has nor widens to the table's type as null there and as text
    in a column beside it."""
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        have = df.schema[f.name].dataType
        if have.simpleString() == f.dataType.simpleString() or _widens(have, f.dataType):
            continue
        value = F.col(f"`{f.name}`")
        text = value.cast("string") if isinstance(have, T.AtomicType) else F.to_json(F.struct(value))
        df = df.withColumn(f"{f.name}_as_text", text).withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


def align(df: DataFrame, schema: T.StructType, *, fill_missing: bool = False) -> DataFrame:
    """``df`` in the column order of ``schema``. Narrower numbers are widened; other columns and other
    types are refused."""
    missing = [n for n in schema.names if n not in df.columns]
    extra = [c for c in df.columns if c not in schema.names]
    if extra or (missing and not fill_missing):
        raise ValueError(f"columns differ from the table: missing {missing}, unknown {extra}")
    out = []
    for f in schema.fields:
        if f.name in missing:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        have = df.schema[f.name].dataType
        if _widens(have, f.dataType):
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
            continue
        if have.simpleString() != f.dataType.simpleString():
            raise ValueError(
                f"column '{f.name}' is {have.simpleString()}, table has {f.dataType.simpleString()}"
            )
        out.append(F.col(f"`{f.name}`"))
    return df.select(*out)

"""Format-dispatched scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.model import ConfigError
from tidemark.sources.tables import VersionedTable

FILE_FORMATS = ("csv", "json", "parquet")
ROW_TEXT_FORMATS = ("csv", "json")
CORRUPT = "_corrupt_line"  # the text of a line that does not fit its format


def read_source(
    spark: SparkSession,
    path: str,
    file_format: str,
    *,
    schema: T.StructType | str | None = None,
    options: dict[str, str] | None = None,
    formats: tuple[str, ...] | None = FILE_FORMATS,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Scan ``path``. Formats outside ``formats`` are refused; ``formats=None`` admits whatever
    Spark can load. ``table`` names a versioned table written by this package. ``keep_corrupt`` adds
    the column ``_corrupt_line`` to files of text lines, null for lines that fit."""
    kind = file_format.lower()
    if kind == "table":
        return VersionedTable(spark, path).read()
    if formats is not None and kind not in formats:
        raise ValueError(f"unsupported file format '{file_format}', expected one of {formats}")
    reader = spark.read.format(kind).options(**(options or {}))
    if keep_corrupt and keeps_lines(kind, options):
        if schema is None:
            schema = reader.load(path).schema
        schema = with_corrupt(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(schema)
        if kind == "csv":  # a file with other columns, or in another order, fails
            reader = reader.option("enforceSchema", (options or {}).get("enforceSchema", "false"))
    return reader.load(path)


def keeps_lines(kind: str, options: dict[str, str] | None) -> bool:
    """Are there lines, and are malformed ones let through rather than dropped or refused?"""
    modes = [v for k, v in (options or {}).items() if k.lower() == "mode"]
    return kind.lower() in ROW_TEXT_FORMATS and all(m.upper() == "PERMISSIVE" for m in modes)


def with_corrupt(schema: T.StructType | str) -> T.StructType:
    schema = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [f for f in schema.fields if f.name not in (CORRUPT, "_corrupt_record")]
    return T.StructType(fields).add(CORRUPT, "string")


def csv_schema(
    spark: SparkSession, path: str, options: dict[str, str] | None, declared: dict[str, str]
) -> T.StructType:
    """Schema of CSV files from declared column types, in the order of their header; columns that are
    not declared are text. Without a header there is no telling which column is which."""
    if str({k.lower(): v for k, v in (options or {}).items()}.get("header", "false")).lower() != "true":
        raise ConfigError(f"CSV files in {path} have no header: give their schema in order")
    names = spark.read.options(**{**(options or {}), "inferSchema": "false"}).csv(path).columns
    return T.StructType([T.StructField(n, T.DataType.fromDDL(declared.get(n, "string"))) for n in names])

"""Every query against its SQL on the same tables."""

from __future__ import annotations

import os
from datetime import date, datetime
from pathlib import Path

import pytest

import __spark_entry__ as contract
from workload.oracle import SQL
from workload.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return value


def normal(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def test_queries_and_sql_have_the_same_names():
    assert set(QUERIES) == set(SQL)


def kind(name):
    """Types by family, so that both engines' names compare."""
    name = str(name).lower()
    for family, names in {
        "int": ("tinyint", "smallint", "integer", "int"),
        "long": ("bigint",),
        "text": ("string", "varchar"),
        "time": ("timestamp_ntz", "timestamp"),
    }.items():
        if name in names:
            return family
    return name


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, sql, name):
    got = contract.queries()[name](spark, SF_DIR)
    rel = sql.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    ours = {f.name: kind(f.dataType.simpleString()) for f in got.schema.fields}
    theirs = {c: kind(t) for c, t in zip(rel.columns, rel.types)}
    assert ours == theirs
    mine, expected = normal(got.columns, got.collect()), normal(rel.columns, rel.fetchall())
    assert len(mine) == len(expected)
    assert mine == expected
    assert mine, "an empty result checks nothing"

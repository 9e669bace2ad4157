from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["TZ"] = "UTC"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    # such as TEST_CONF="spark.tidemark.broadcastBytes=0 spark.tidemark.hotRows=1000"
    for option in os.environ.get("TEST_CONF", "").split():
        builder = builder.config(*option.split("=", 1))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from tidemark.scratch import Scratch

    return Scratch(spark)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def put(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield put
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df):
    """Rows as a sorted list of tuples, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

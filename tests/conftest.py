from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagloom.schemas import HISTORY  # noqa: E402
from tagloom.session import configure  # noqa: E402

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def at(seconds: float) -> datetime:
    """An instant some seconds after the start of 2024."""
    return T0 + timedelta(seconds=seconds)


def sec(ts: datetime | None):
    return None if ts is None else (ts - T0).total_seconds()


@pytest.fixture
def hist(spark):
    """History from (tag, seconds, value[, quality]) rows."""

    def make(rows):
        full = [
            (r[0], at(r[1]), None if r[2] is None else float(r[2]), r[3] if len(r) > 3 else 192)
            for r in rows
        ]
        return spark.createDataFrame(full, HISTORY)

    return make


@pytest.fixture
def table(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make

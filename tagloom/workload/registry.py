"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.workload.tables import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, recursive: bool = False):
    """Register a function of ``Tables`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql, recursive)
        return build

    return register


# Decimals kept of computed doubles, here and in the SQL.
DECIMALS = {
    "average": 4,
    "std_dev": 3,
    "integral": 2,
    "percent_good": 4,
    "state_percent": 4,
    "avg_contained_ms": 3,
    "range": 4,
    "avg_life_s": 3,
    "minutes_remaining": 4,
}


def rounded(df: DataFrame) -> DataFrame:
    """Computed doubles rounded, so that sums in another order compare equal."""
    return df.select(
        *[
            F.round(c, DECIMALS[c]).alias(c) if c in DECIMALS else F.col(c)
            for c in df.columns
        ]
    )


def rounded_sql(*names: str) -> str:
    return ", ".join(f"round({n}, {DECIMALS[n]}) AS {n}" if n in DECIMALS else n for n in names)

"""Summary states: the sums of each tag and hour, kept beside a history folder so that long profiles read no samples.

A state holds an hour's own samples only: sums up to its last sample, and that sample. The value carried into an hour belongs to
the state before it, so a late sample changes one state and no later one, and ``summary_of_states`` merges states to cycles of
any whole hours. States lie in a folder per day. ``append_with_states`` names the days it is about to touch, appends, computes
these days anew and takes their names back; until then, and if it dies half-way, readers compute the named days from samples.
One job at a time may append.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.time import HOUR, floor_div, micros
from tagloom.operators.summary import block_sums
from tagloom.session import ensure
from tagloom.sources.history import append_samples, good_value, read_history
from tagloom.sources.state import prune_versions, read_version, versions, write_version

STATE = (
    "tag string, hour bigint, first_us bigint, last_us bigint, last_value double, samples bigint, good_us bigint, "
    "area double, area2 double, low double, low_us bigint, high double, high_us bigint"
)


def hour_states(df: DataFrame) -> DataFrame:
    """The state of each tag and hour that has samples, with its ``day``."""
    ensure(df.sparkSession)
    us = micros(F.col("ts"))
    samples = df.filter("tag IS NOT NULL AND ts IS NOT NULL").select(
        "tag", floor_div(us, HOUR).alias("hour"), us.alias("us"), good_value().alias("value")
    )
    sums = block_sums(samples, ["hour", "tag"])
    names = [c.split()[0] for c in STATE.split(", ")]
    return sums.select(*names, F.date_add(F.lit(date(1970, 1, 1)), floor_div(F.col("hour"), 24).cast("int")).alias("day"))


def _pending(spark: SparkSession, states: str) -> set[date]:
    return {r["day"] for r in read_version(spark, f"{states}/pending", "day date").collect()}


def _name(spark: SparkSession, states: str, days: set[date]) -> None:
    path = f"{states}/pending"
    rows = spark.createDataFrame([(d,) for d in sorted(days)], "day date")
    write_version(rows, path, (versions(spark, path) or [0])[-1] + 1)
    prune_versions(spark, path)


def refresh_states(spark: SparkSession, path: str, states: str, days: set[date]) -> None:
    """Compute the states of some days anew from the history at ``path``; other days are neither read nor written."""
    rows = read_history(spark, path).filter(F.col("day").isin(sorted(days)))
    (
        hour_states(rows)
        .repartitionByRange("day", "tag", "hour")
        .sortWithinPartitions("day", "tag", "hour")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(f"{states}/hours")
    )


def append_with_states(df: DataFrame, path: str, states: str) -> None:
    """``append_samples``, and the states of the days it touches brought into step, late samples' days included."""
    spark = df.sparkSession
    touched = {r["day"] for r in df.select(F.to_date("ts").alias("day")).distinct().collect()} - {None}
    if not touched:
        return
    named = touched | _pending(spark, states)
    _name(spark, states, named)
    append_samples(df, path)
    refresh_states(spark, path, states, named)
    _name(spark, states, set())


def read_states(spark: SparkSession, path: str, states: str) -> DataFrame:
    """The states of the history at ``path`` whose first rows came by ``append_with_states``."""
    named = sorted(_pending(spark, states))
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{states}/hours")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return hour_states(read_history(spark, path))
    kept = spark.read.schema(f"{STATE}, day date").parquet(f"{states}/hours")
    if not named:
        return kept
    anew = hour_states(read_history(spark, path).filter(F.col("day").isin(named)))
    return kept.filter(~F.col("day").isin(named)).unionByName(anew)

"""Reading and writing tag history: tag, ts, value, quality."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.time import as_datetime, between_ts, micros, to_us, ts_lit
from tagloom.schemas import GOOD


def good_value(value: str = "value", quality: str = "quality") -> Column:
    """The value of a good sample, NULL for a bad or missing one."""
    return F.when(F.col(quality) == GOOD, F.col(value))


def scan_history(
    df: DataFrame,
    tags: Iterable[str] | None = None,
    start=None,
    end=None,
    bounds: str = "[)",
) -> DataFrame:
    """Samples of some tags in a time range; the ends are open or closed as
    ``bounds`` says. Both filters reach the scan, and a history stored by
    ``day`` is pruned to the days in the range."""
    if tags is not None:
        df = df.filter(F.col("tag").isin(list(tags)))
    if start is not None or end is not None:
        df = df.filter(between_ts(F.col("ts"), start, end, bounds))
        df = df.filter(_days(df, start, end))
    return df


def _days(df: DataFrame, start, end) -> Column:
    """Test on the ``day`` partition column, true where there is none."""
    test = F.lit(True)
    if "day" in df.columns:
        if start is not None:
            test = test & (F.col("day") >= F.lit(as_datetime(start).date()))
        if end is not None:
            test = test & (F.col("day") <= F.lit(as_datetime(end).date()))
    return test


def for_tags(df: DataFrame, tags_df: DataFrame) -> DataFrame:
    """Samples of the tags listed in a table.

    The list is not hinted: Spark broadcasts it when its size allows and
    otherwise joins by shuffle, where a busy tag is split as a skewed key.
    """
    return df.join(tags_df.select("tag").distinct(), "tag", "left_semi")


def live(df: DataFrame) -> DataFrame:
    """The latest row of each tag; reduced before the shuffle."""
    return df.groupBy("tag").agg(
        F.max("ts").alias("ts"),
        F.max_by("value", "ts").alias("value"),
        F.max_by("quality", "ts").alias("quality"),
    )


def start_bound(df: DataFrame, start) -> DataFrame:
    """The value each tag has at ``start``: its last sample at or before it,
    stamped at ``start``. ``sampled_ts`` is the sample's own time."""
    before = scan_history(df, None, None, start, "[]")
    return live(before).select(
        "tag",
        ts_lit(start).alias("ts"),
        "value",
        "quality",
        F.col("ts").alias("sampled_ts"),
    )


def snapshot(df: DataFrame, at) -> DataFrame:
    """The last sample of each tag at or before an instant, to be stored."""
    return live(scan_history(df, None, None, at, "[]"))


def from_snapshot(df: DataFrame, stored: DataFrame, at) -> DataFrame:
    """History that answers as ``df`` does for any range starting after ``at``,
    without reading the samples up to there.

    ``stored`` is the ``snapshot`` of that instant. Values in force at the start
    of a range otherwise cost a scan of all earlier samples.
    """
    columns = ["tag", "ts", "value", "quality"]
    later = scan_history(df, None, at, None, "()")
    return stored.select(*columns).unionByName(later.select(*columns))


def samples_us(df: DataFrame, start, end, bounds: str = "[)") -> DataFrame:
    """Samples in a range as tag, us, value (NULL unless good), and
    ``carried``, false."""
    return scan_history(df, None, start, end, bounds).select(
        "tag",
        micros(F.col("ts")).alias("us"),
        good_value().alias("value"),
        F.lit(False).alias("carried"),
    )


def bound_us(df: DataFrame, start) -> DataFrame:
    """The start-bound row of each tag like ``samples_us``; ``carried`` is true
    for one sampled before ``start``."""
    return start_bound(df, start).select(
        "tag",
        F.lit(to_us(start)).cast("long").alias("us"),
        good_value().alias("value"),
        (F.col("sampled_ts") < ts_lit(start)).alias("carried"),
    )


def in_range_us(df: DataFrame, start, end, closed_end: bool = False) -> DataFrame:
    """The start-bound row of each tag and the samples after it, up to ``end``.

    A sample at exactly ``start`` is the start-bound row.
    """
    samples = samples_us(df, start, end, "(]" if closed_end else "()")
    return bound_us(df, start).unionByName(samples)


def in_time_zone(df: DataFrame, tz: str, source: str = "UTC", ts: str = "ts") -> DataFrame:
    """Express a timestamp column of zone ``source`` in zone ``tz``."""
    return df.withColumn(ts, F.convert_timezone(F.lit(source), F.lit(tz), F.col(ts)))


def latest_version(
    df: DataFrame, version: str = "version", keys: Iterable[str] = ("tag", "ts")
) -> DataFrame:
    """One row per (tag, ts): the one with the highest version, and of several
    with that version the one whose other columns are the largest in order."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != version]
    newest = F.max(F.struct(version, *rest)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def append_samples(df: DataFrame, path: str) -> None:
    """Append samples to a history folder, partitioned by day.

    Rows are split by range of day, tag and time, whatever their skew, so that
    each task writes few files and each file covers few tags and a short time.
    """
    order = ["day", "tag", "ts"]
    (
        df.select("tag", "ts", "value", "quality", F.to_date("ts").alias("day"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("append")
        .partitionBy("day")
        .parquet(path)
    )


def read_history(spark, path: str) -> DataFrame:
    """A history folder written by ``append_samples``; ``scan_history`` prunes
    its days, and filters on tag and time its row groups."""
    return spark.read.parquet(path)

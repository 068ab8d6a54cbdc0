"""Text export of history, one time slice after another."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.time import ts_lit
from tagloom.operators.retrieval import delta
from tagloom.schemas import BOOKMARK
from tagloom.sources.history import for_tags, in_time_zone, live, scan_history
from tagloom.sources.state import prune_versions, read_version, versions, write_version

# Parts of the file format (fixed values): encoding, delimiter, original value,
# engineering units, and the options after the origin: UTC, original values
# with tag names, limited to the span of the file.
ENCODING = "ASCII"
DELIMITER = "|"
ORIGINAL_VALUE = "0"
ENGINEERING_UNITS = "0"
ORIGIN_OPTIONS = ("0", "UTC", "10", "1")


def header_lines(origin: str) -> list[str]:
    return [ENCODING, DELIMITER, DELIMITER.join((origin, *ORIGIN_OPTIONS))]


def fastload_lines(df: DataFrame) -> DataFrame:
    """One text line per sample; NULL where the value (or another part) is NULL."""
    bar = F.lit(DELIMITER)
    line = F.concat(
        F.col("tag"), bar,
        F.lit(ORIGINAL_VALUE), bar,
        F.date_format("ts", "yyyy/MM/dd"), bar,
        F.date_format("ts", "HH:mm:ss.SSS"), bar,
        F.lit(ENGINEERING_UNITS), bar,
        F.col("value").cast("string"), bar,
        F.col("quality").cast("string"),
    )
    return df.select(line.alias("line"))


def write_fastload(df: DataFrame, path: str, origin: str = "tagloom") -> dict[str, int]:
    """Write ``path/header`` and ``path/data`` as text.

    NULL lines are left out of the file; both kinds are counted in the same
    pass. The parts together, header first, are one import file.
    """
    counts = Observation("export")
    lines = fastload_lines(df).observe(
        counts,
        F.count("line").alias("written"),
        F.count_if(F.col("line").isNull()).alias("dropped"),
    )
    spark = df.sparkSession
    header = spark.createDataFrame([(line,) for line in header_lines(origin)], "line string")
    header.coalesce(1).write.mode("overwrite").text(f"{path}/header")
    lines.filter("line IS NOT NULL").write.mode("overwrite").text(f"{path}/data")
    return {k: int(v) for k, v in counts.get.items()}


def tags_in_group(
    ns: DataFrame, group_tag: DataFrame, tag_ref: DataFrame, tag: DataFrame, name: str, before
) -> DataFrame:
    """Tags of the groups called ``name`` that existed before an instant."""
    groups = ns.filter(F.col("name") == name).select("name_key")
    older = tag.filter(F.col("date_created") < ts_lit(before)).select("tag")
    return (
        group_tag.join(groups, "name_key")
        .join(tag_ref, "domain_tag_key")
        .join(older, "tag")
        .select("tag")
        .distinct()
    )


@dataclass(frozen=True)
class ExportWindow:
    start: datetime
    end: datetime
    number: int


def next_export_window(bookmark, hours: int = 24) -> ExportWindow | None:
    """The slice after the last one exported, or None when all is done.

    ``bookmark`` is a row with start_ts, end_ts, last_end_ts, export_count. The
    last slice ends at ``end_ts``.
    """
    start = bookmark["last_end_ts"] or bookmark["start_ts"]
    if start < bookmark["start_ts"] or start >= bookmark["end_ts"]:
        return None
    end = min(start + timedelta(hours=hours), bookmark["end_ts"])
    return ExportWindow(start, end, bookmark["export_count"] + 1)


def set_bookmark(spark: SparkSession, path: str, start, end, group_name: str | None = None) -> None:
    """Begin a new series of exports over (start, end]."""
    row = spark.createDataFrame([(start, end, None, 0, group_name)], BOOKMARK)
    write_version(row, path, (versions(spark, path) or [0])[-1] + 1)


def export_next(
    df: DataFrame,
    tags: DataFrame,
    bookmark_path: str,
    out_path: str,
    hours: int = 24,
    time_zone: str = "UTC",
    origin: str = "tagloom",
) -> tuple[ExportWindow, dict[str, int]] | None:
    """Export the changes of the next slice, then move the bookmark on.

    The first sample of the series counts as a change; in later slices a tag's
    last sample before the slice decides whether its first one is, so the
    slices together hold the same lines whatever their width. These samples are
    handed from slice to slice beside the bookmark, so each slice reads its own
    range of history alone; a tag listed later in a series begins with its first
    slice. The slice is read once and held, on disk where memory ends. It goes to its own numbered folder and the bookmark moves last,
    so a failed export is simply run again. Times are in ``time_zone`` on input
    and in UTC in the file.
    """
    spark = df.sparkSession
    bookmark = read_version(spark, bookmark_path, BOOKMARK).first()
    window = next_export_window(bookmark, hours) if bookmark else None
    if window is None:
        return None
    utc = df if time_zone == "UTC" else in_time_zone(df, "UTC", source=time_zone)
    listed = for_tags(utc, tags)
    columns = ["tag", "ts", "value", "quality"]
    rows = scan_history(listed, None, window.start, window.end, "(]").select(*columns)
    last_path = f"{bookmark_path}/last"
    if window.start > bookmark["start_ts"]:
        if window.number - 1 in versions(spark, last_path):
            before = read_version(spark, last_path, rows.schema, window.number)
        else:  # a series begun before samples were handed on
            before = live(scan_history(listed, None, bookmark["start_ts"], window.start, "(]"))
        rows = for_tags(before, tags).select(*columns).unionByName(rows)
    rows = rows.persist()  # one look for the slice in the history, for what is handed on and for the changes
    try:
        write_version(live(rows).select(*columns), last_path, window.number)
        prune_versions(spark, last_path)
        changes = delta(rows).filter(F.col("ts") > ts_lit(window.start))
        counts = write_fastload(changes, f"{out_path}/export-{window.number:06d}", origin)
    finally:
        rows.unpersist()
    moved = spark.createDataFrame(
        [
            (
                bookmark["start_ts"],
                bookmark["end_ts"],
                window.end,
                window.number,
                bookmark["group_name"],
            )
        ],
        BOOKMARK,
    )
    write_version(moved, bookmark_path, versions(spark, bookmark_path)[-1] + 1)
    return window, counts

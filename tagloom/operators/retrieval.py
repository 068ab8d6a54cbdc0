"""Retrieval modes: changes, cycles, edges and the wide (pivoted) view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.time import MS, between_ts, div, instant, micros
from tagloom.plans.blocks import BLOCK_MS, block_of, in_order, runs, tree_neighbours
from tagloom.plans.cycles import Cycles
from tagloom.sources.history import good_value, in_range_us, live, scan_history

EDGE_MODES = ("leading", "trailing", "both")


def delta(
    df: DataFrame,
    start=None,
    end=None,
    bounds: str = "()",
    on: Sequence[str] = ("value", "quality"),
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """One row per change of value or quality, with the time to the next change.

    ``duration_ms`` is NULL on the last row of a tag. The first sample in the
    range counts as a change.
    """
    rows = scan_history(df, None, start, end, bounds).select(
        "tag", micros(F.col("ts")).alias("us"), "value", "quality"
    )
    changes = runs(rows, on, block_ms=block_ms)
    return changes.select(
        "tag",
        instant(F.col("us")).alias("ts"),
        "value",
        "quality",
        div(F.col("end_us") - F.col("us"), MS).alias("duration_ms"),
    )


def cyclic(
    df: DataFrame, start, end, resolution_ms: int | None = None, cycles: int | None = None
) -> DataFrame:
    """The value each tag has at the start of every cycle in [start, end).

    Samples are reduced to the last one before each cycle start ahead of the
    shuffle; NULL until a tag's first sample. A bad sample gives NULL.
    """
    grid = Cycles.of(start, end, resolution_ms, cycles)
    lo = F.lit(grid.start_us).cast("long")
    us = micros(F.col("ts"))
    # First cycle start at or after the sample.
    due = F.when(us <= lo, F.lit(0).cast("long")).otherwise(
        div(us - lo + F.lit(grid.width_us - 1).cast("long"), grid.width_us)
    )
    last = (
        scan_history(df, None, None, end, "[)")
        .select("tag", us.alias("us"), good_value().alias("value"), due.alias("k"))
        .groupBy("tag", "k")
        .agg(F.max_by("value", "us").alias("value"))
    )
    stop = F.coalesce("_next_first", F.lit(grid.count).cast("long"))
    spans = tree_neighbours(last, ["tag"], F.col("k"), "k", {}, "k").select(
        "tag",
        "k",
        "value",
        F.when(F.col("_opens"), F.lit(0).cast("long")).otherwise(F.col("k")).alias("from_k"),
        F.least(stop - 1, F.lit(grid.count - 1)).alias("to_k"),
    ).filter("from_k <= to_k")
    return spans.select(
        "tag", "k", "value", F.explode(F.sequence("from_k", "to_k")).alias("cycle")
    ).select(
        "tag",
        instant(grid.begin(F.col("cycle"))).alias("ts"),
        F.when(F.col("cycle") >= F.col("k"), F.col("value")).alias("value"),
    )


def since(df: DataFrame, start, end, closed_end: bool = True) -> DataFrame:
    """Samples in [start, end] and, per tag, the last one before ``start``."""
    columns = ("tag", "ts", "value", "quality")
    if start is None:
        return scan_history(df, None, None, end, "[]" if closed_end else "[)").select(*columns)
    prior = live(scan_history(df, None, None, start, "[)")).select(*columns)
    inside = scan_history(df, None, start, end, "[]" if closed_end else "[)").select(*columns)
    return prior.unionByName(inside)


def edges(
    df: DataFrame,
    pred: Column,
    mode: str = "leading",
    start=None,
    end=None,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Samples in [start, end] at which a predicate turns true or false.

    ``pred`` is a column over ``tag``, ``value`` and ``quality``; NULL counts as
    false. A tag's first sample is an edge when the predicate holds on it. The
    last sample before ``start`` decides whether the first one in the range is
    an edge, so earlier history is not sorted.
    """
    if mode not in EDGE_MODES:
        raise ValueError(f"mode must be one of {EDGE_MODES}")
    rows = since(df, start, end).select(
        "tag",
        micros(F.col("ts")).alias("us"),
        "value",
        "quality",
        F.coalesce(pred, F.lit(False)).alias("on"),
    )
    turns = runs(rows, ["on"], block_ms=block_ms)
    wanted = {
        "leading": F.col("on"),
        "trailing": ~F.col("on") & ~F.col("first_run"),
        "both": F.col("on") | ~F.col("first_run"),
    }[mode]
    ts = instant(F.col("us"))
    return (
        turns.filter(wanted)
        .filter(between_ts(ts, start, None, "[]"))
        .select(
            "tag",
            ts.alias("ts"),
            "value",
            "quality",
            F.when(F.col("on"), "leading").otherwise("trailing").alias("edge"),
            div(F.col("end_us") - F.col("us"), MS).alias("duration_ms"),
        )
    )


def wide_us(df: DataFrame, tags: Sequence[str], start, end, block_ms: int) -> DataFrame:
    """``wide`` on microseconds, with ``next_us``."""
    tags = list(tags)
    listed = scan_history(df, tags)
    changes = runs(in_range_us(listed, start, end, closed_end=True), ["value"], block_ms=block_ms)
    # NaN stands for "changed to NULL" until the values are filled forward.
    marked = F.coalesce(F.col("value"), F.lit(float("nan")))
    columns = [f"_tag_{i}" for i in range(len(tags))]
    # Partitioned by block at once: instants and the order within a block need
    # no further shuffle.
    pivoted = (
        changes.select("tag", "us", marked.alias("v"), block_of(F.col("us"), block_ms).alias("_blk"))
        .repartition("_blk")
        .groupBy("_blk", "us")
        .agg(*[F.max(F.when(F.col("tag") == t, F.col("v"))).alias(c) for t, c in zip(tags, columns)])
    )
    filled = in_order(pivoted, columns, keys=(), block_ms=block_ms)
    return filled.select(
        "us",
        *[F.when(~F.isnan(c), F.col(c)).alias(t) for t, c in zip(tags, columns)],
        "next_us",
    )


def wide(
    df: DataFrame, tags: Sequence[str], start, end, block_ms: int = BLOCK_MS
) -> DataFrame:
    """One row per instant in [start, end] at which any listed tag changes, one
    column per tag holding its value in force, and the time to the next row.

    Starts with the values in force at ``start``. Changes of several tags at
    one instant share a row.
    """
    rows = wide_us(df, tags, start, end, block_ms)
    return rows.select(
        instant(F.col("us")).alias("ts"),
        *[F.col(f"`{t}`") for t in tags],
        div(F.col("next_us") - F.col("us"), MS).alias("duration_ms"),
    )

"""Summaries per cycle: analog (time-weighted) and time-in-state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.time import MS, SECOND, as_datetime, div, instant, midnight, shift, ts_lit
from tagloom.plans.blocks import BLOCK_MS, block_of, runs, tree_neighbours
from tagloom.plans.cycles import Cycles
from tagloom.session import ensure
from tagloom.sources.history import bound_us, for_tags, in_range_us, samples_us, scan_history

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def weighted(value: Column, us: Column) -> list[Column]:
    """Sums from which the time-weighted statistics follow."""
    seconds = us / F.lit(float(SECOND))
    return [
        F.sum(F.when(value.isNotNull(), us)).alias("good_us"),
        F.sum(value * seconds).alias("area"),
        F.sum(value * value * seconds).alias("area2"),
        F.min(F.when(value.isNotNull(), F.struct(value.alias("v"), F.col("us").alias("us")))).alias(
            "lowest"
        ),
        # The earliest of equal maxima: the smallest time, so it is negated.
        F.max(
            F.when(value.isNotNull(), F.struct(value.alias("v"), (-F.col("us")).alias("us")))
        ).alias("highest"),
    ]


def statistics(length_us: Column) -> dict[str, Column]:
    """Summary columns from the sums of ``weighted`` over an interval."""
    seconds = F.col("good_us") / F.lit(float(SECOND))
    average = F.when(F.col("good_us") > 0, F.col("area") / seconds)
    mean_square = F.when(F.col("good_us") > 0, F.col("area2") / seconds)
    return {
        "minimum": F.col("lowest.v"),
        "min_ts": instant(F.col("lowest.us")),
        "maximum": F.col("highest.v"),
        "max_ts": instant(-F.col("highest.us")),
        "average": average,
        # GREATEST skips NULLs; without weight there is no deviation either.
        "std_dev": F.when(
            average.isNotNull(), F.sqrt(F.greatest(mean_square - average * average, F.lit(0.0)))
        ),
        "integral": F.col("area"),
        "value_count": F.coalesce("samples", F.lit(0)).cast("long"),
        "percent_good": F.coalesce("good_us", F.lit(0)) * F.lit(100.0) / length_us,
    }


def analog_summary(
    df: DataFrame,
    start,
    end,
    resolution_ms: int | None = None,
    cycles: int | None = None,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Time-weighted statistics per tag and cycle of [start, end).

    A value holds until the next sample and is split at cycle edges; a value in
    force at ``start`` counts. Bad and NULL samples carry no weight but lower
    ``percent_good``. Every cycle of a tag seen before ``end`` gives a row; its
    statistics are NULL while the tag has no value.

    Samples are shuffled once, by tag, cycle and block, and summed there. Only
    the value leaving each block is spread over the cycles it reaches, so a
    sample is never multiplied and a busy tag is shared among many tasks.
    """
    ensure(df.sparkSession)
    grid = Cycles.of(start, end, resolution_ms, cycles)
    part = ["cycle", "block", "tag"]
    begin = grid.begin(F.col("cycle"))

    bound = bound_us(df, start).select(
        "tag",
        F.lit(0).cast("long").alias("cycle"),
        F.col("us").alias("first_us"),
        F.col("us").alias("last_us"),
        F.col("value").alias("last_value"),
        F.when(F.col("carried"), 0).otherwise(1).cast("long").alias("samples"),
    )

    inside = (
        samples_us(df, start, end, "()")
        .withColumn("cycle", grid.index(F.col("us")))
        .withColumn("block", block_of(F.col("us") - begin, block_ms))
    )
    return _of_blocks(bound, block_sums(inside, part).drop("block"), grid, block_ms)


def block_sums(inside: DataFrame, part: Sequence[str]) -> DataFrame:
    """The samples of each block combined: sums up to its last sample, and that sample, whose value goes on from there.

    Such rows can be kept instead of samples: what a summary needs besides is only which row comes next.
    """
    order = Window.partitionBy(*part).orderBy("us")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = inside.select(
        *part,
        "us",
        "value",
        (F.lead("us").over(order) - F.col("us")).alias("held_us"),
        F.min("value").over(whole).alias("low"),
        F.max("value").over(whole).alias("high"),
    )
    # Plain columns only, so that the sums are kept in a hash table.
    held_s = F.col("held_us") / F.lit(float(SECOND))
    return inside.groupBy(*part).agg(
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
        F.max_by("value", "us").alias("last_value"),
        F.count("*").alias("samples"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("held_us"))).alias("good_us"),
        F.sum(F.col("value") * held_s).alias("area"),
        F.sum(F.col("value") * F.col("value") * held_s).alias("area2"),
        F.min("low").alias("low"),
        F.min(F.when(F.col("value") == F.col("low"), F.col("us"))).alias("low_us"),
        F.max("high").alias("high"),
        F.min(F.when(F.col("value") == F.col("high"), F.col("us"))).alias("high_us"),
    )


def summary_of_states(states: DataFrame, start, end, resolution_ms: int) -> DataFrame:
    """``analog_summary`` from the sums kept per tag and hour (see ``sources.states``) instead of samples.

    ``start``, ``end`` and the resolution must be whole hours.
    """
    ensure(states.sparkSession)
    grid = Cycles.of(start, end, resolution_ms)
    if any(us % (HOUR_MS * MS) for us in (grid.start_us, grid.end_us, grid.width_us)):
        raise ValueError("sums are kept per hour")
    first, last = grid.start_us // (HOUR_MS * MS), grid.end_us // (HOUR_MS * MS)
    sums = [c for c in states.columns if c not in ("day", "hour")]
    blocks = states.filter(F.col("hour").between(first, last - 1)).select(
        F.lit(0).cast("long").alias("cycle"), *sums
    ).withColumn("cycle", grid.index(F.col("first_us")))
    # A tag with a sample at the start itself has its value in force from that.
    fresh = blocks.filter(F.col("first_us") == grid.start_us).select("tag")
    bound = (
        states.filter(F.col("hour") < first)
        .groupBy("tag")
        .agg(F.max_by("last_value", "last_us").alias("last_value"))
        .join(fresh, "tag", "left_anti")
        .select(
            "tag",
            F.lit(0).cast("long").alias("cycle"),
            F.lit(grid.start_us).cast("long").alias("first_us"),
            F.lit(grid.start_us).cast("long").alias("last_us"),
            "last_value",
            F.lit(0).cast("long").alias("samples"),
        )
    )
    return _of_blocks(bound, blocks, grid, HOUR_MS)


def _of_blocks(bound: DataFrame, blocks: DataFrame, grid: Cycles, block_ms: int) -> DataFrame:
    """Cycle statistics from the values in force at the start and the sums of blocks that each lie in one cycle."""
    begin = grid.begin(F.col("cycle"))
    # The value leaving a block holds until the tag's next sample or the end.
    place = div(F.col("first_us") - F.lit(grid.start_us).cast("long"), min(block_ms * MS, grid.width_us))
    known = bound.unionByName(blocks, allowMissingColumns=True)
    spans = (
        tree_neighbours(known, ["tag"], place, "first_us", {}, "last_us")
        .withColumn("until", F.coalesce("_next_first", F.lit(grid.end_us).cast("long")))
        .withColumnRenamed("_opens", "opens_tag")
        .withColumn(
            "each",
            F.explode(
                F.sequence(
                    F.when(F.col("opens_tag"), F.lit(0).cast("long")).otherwise(F.col("cycle")),
                    grid.index(F.col("until") - 1),
                )
            ),
        )
    )
    own = F.col("each") == F.col("cycle")
    held = (F.col("each") >= F.col("cycle")) & F.col("last_value").isNotNull()
    from_us = F.when(own, F.col("last_us")).otherwise(grid.begin(F.col("each")))
    held_us = F.least(F.col("until"), grid.finish(F.col("each"))) - from_us
    tail = F.when(held, F.col("last_value"))
    seconds = held_us / F.lit(float(SECOND))

    def kept(name: str) -> Column:
        return F.when(own, F.col(name))

    def extreme(value: str, us: Column) -> Column:
        return F.struct(F.col(value).alias("v"), us.alias("us"))

    pieces = spans.select(
        "tag",
        F.col("each").alias("cycle"),
        kept("samples").alias("samples"),
        (F.coalesce(kept("good_us"), F.lit(0)) + F.when(held, held_us).otherwise(0)).alias("good_us"),
        F.when(
            tail.isNull(), kept("area")
        ).otherwise(F.coalesce(kept("area"), F.lit(0.0)) + tail * seconds).alias("area"),
        F.when(
            tail.isNull(), kept("area2")
        ).otherwise(F.coalesce(kept("area2"), F.lit(0.0)) + tail * tail * seconds).alias("area2"),
        F.least(
            F.when(own & F.col("low").isNotNull(), extreme("low", F.col("low_us"))),
            F.when(held, extreme("last_value", from_us)),
        ).alias("lowest"),
        F.greatest(
            F.when(own & F.col("high").isNotNull(), extreme("high", -F.col("high_us"))),
            F.when(held, extreme("last_value", -from_us)),
        ).alias("highest"),
    )
    totals = pieces.groupBy("tag", "cycle").agg(
        F.sum("samples").alias("samples"),
        F.sum("good_us").alias("good_us"),
        F.sum("area").alias("area"),
        F.sum("area2").alias("area2"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    )
    length = grid.finish(F.col("cycle")) - begin
    return totals.select(
        "tag",
        instant(begin).alias("start_ts"),
        instant(grid.finish(F.col("cycle"))).alias("end_ts"),
        *[c.alias(name) for name, c in statistics(length).items()],
    )


def full_summary(df: DataFrame, start, end, block_ms: int = BLOCK_MS) -> DataFrame:
    """One analog summary per tag over the whole range."""
    return analog_summary(df, start, end, cycles=1, block_ms=block_ms)


def state_summary(
    df: DataFrame,
    start,
    end,
    resolution_ms: int | None = None,
    cycles: int | None = None,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Count and time per tag, cycle and state in [start, end).

    A state is a run of equal values; bad and NULL samples form the NULL state.
    ``state_count`` counts the runs touching the cycle; the contained figures
    use only runs that begin and end inside it. A run that began before
    ``start`` or is open at ``end`` is never contained.
    """
    grid = Cycles.of(start, end, resolution_ms, cycles)
    states = runs(in_range_us(df, start, end), ["value"], block_ms=block_ms)
    stop = F.coalesce("end_us", F.lit(grid.end_us).cast("long"))
    pieces = states.select(
        "tag",
        "us",
        "end_us",
        "carried",
        F.col("value").alias("state"),
        stop.alias("stop_us"),
        F.explode(F.sequence(grid.index(F.col("us")), grid.index(stop - 1))).alias("cycle"),
    )
    begin, finish = grid.begin(F.col("cycle")), grid.finish(F.col("cycle"))
    inside_us = F.least("stop_us", finish) - F.greatest("us", begin)
    contained = (
        (F.col("us") >= begin)
        & (F.col("end_us") <= finish)
        & ~F.col("carried")
    )
    whole = F.when(contained, div(F.col("end_us") - F.col("us"), MS))
    totals = pieces.groupBy("tag", "cycle", "state").agg(
        F.count("*").alias("state_count"),
        F.sum(inside_us).alias("state_us"),
        F.avg(whole).alias("avg_contained_ms"),
        F.min(whole).alias("min_contained_ms"),
        F.max(whole).alias("max_contained_ms"),
    )
    return totals.select(
        "tag",
        instant(begin).alias("start_ts"),
        instant(finish).alias("end_ts"),
        "state",
        "state_count",
        div(F.col("state_us"), MS).alias("state_ms"),
        (F.col("state_us") * F.lit(100.0) / (finish - begin)).alias("state_percent"),
        "avg_contained_ms",
        "min_contained_ms",
        "max_contained_ms",
    )


def state_summary_filled(
    df: DataFrame, tags: DataFrame, state: float, start, end, block_ms: int = BLOCK_MS
) -> DataFrame:
    """Count and time of one state per requested tag over [start, end), 0 for
    a tag that was never in it. The state is tested before the outer join."""
    wanted = state_summary(for_tags(df, tags), start, end, cycles=1, block_ms=block_ms).filter(
        F.col("state") == state
    )
    return (
        tags.select("tag")
        .join(wanted, "tag", "left")
        .select(
            "tag",
            F.coalesce("state_count", F.lit(0)).alias("state_count"),
            F.coalesce("state_ms", F.lit(0)).alias("state_ms"),
        )
    )


def hour_of_day(
    df: DataFrame | None,
    now,
    days: int = 30,
    mode: str = "rolling",
    block_ms: int = BLOCK_MS,
    states: DataFrame | None = None,
) -> DataFrame:
    """Statistics per tag and hour of day over hourly summaries, of samples or of the ``states`` kept of them.

    The range runs from ``days`` before next midnight up to the last whole hour
    before ``now``. ``rolling`` labels an hour with its latest start;
    ``fixed`` with its place in the 24 hours that end next midnight.
    """
    if mode not in ("rolling", "fixed"):
        raise ValueError("mode must be rolling or fixed")
    next_midnight = midnight(now, 1)
    start = midnight(now, 1 - days)
    last_hour = as_datetime(now).replace(minute=0, second=0, microsecond=0)
    if states is None:
        hourly = analog_summary(df, start, last_hour, resolution_ms=HOUR_MS, block_ms=block_ms)
    else:
        hourly = summary_of_states(states, start, last_hour, HOUR_MS)
    label = (
        F.max("start_ts")
        if mode == "rolling"
        else shift(ts_lit(next_midnight), hours=F.col("hour_of_day") - 24)
    )
    return (
        hourly.withColumn("hour_of_day", F.hour("start_ts"))
        .groupBy("tag", "hour_of_day")
        .agg(
            label.alias("ts"),
            F.min("minimum").alias("minimum"),
            F.max("maximum").alias("maximum"),
            F.avg("average").alias("average"),
            F.stddev_pop("average").alias("std_dev"),
            F.avg("percent_good").alias("percent_good"),
            F.count("*").alias("count"),
        )
        .orderBy("tag", "ts" if mode == "rolling" else "hour_of_day")
    )


def resource_report(
    df: DataFrame,
    analog_tags: Sequence[str],
    state_tags: Sequence[str],
    state: float,
    start,
    end,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """One-cycle load summary of some tags, with time-in-state rows of others
    laid on the same columns: the contained times as average, minimum and
    maximum, the count as deviation, no range. Duplicate rows are merged."""
    analog = full_summary(scan_history(df, analog_tags), start, end, block_ms).select(
        "start_ts",
        "tag",
        "average",
        "minimum",
        "maximum",
        "std_dev",
        (F.col("maximum") - F.col("minimum")).alias("range"),
        F.round("percent_good", 0).alias("percent_good"),
    )
    states = state_summary(scan_history(df, state_tags), start, end, cycles=1, block_ms=block_ms)
    in_state = states.filter(F.col("state") == state).select(
        "start_ts",
        F.concat("tag", F.lit(f" ({state:g})")).alias("tag"),
        F.col("avg_contained_ms").cast("double").alias("average"),
        F.col("min_contained_ms").cast("double").alias("minimum"),
        F.col("max_contained_ms").cast("double").alias("maximum"),
        F.col("state_count").cast("double").alias("std_dev"),
        F.lit(None).cast("double").alias("range"),
        F.col("state_percent").alias("percent_good"),
    )
    return analog.unionByName(in_state).distinct()


def daily_load(
    df: DataFrame | None,
    tags: Sequence[str],
    now,
    days: int = 30,
    block_ms: int = BLOCK_MS,
    states: DataFrame | None = None,
) -> DataFrame:
    """Daily average, deviation, maximum and percent good of some tags over the
    ``days`` before the last midnight, from samples or from the ``states`` kept of them."""
    start, end = midnight(now, -days), midnight(now)
    if states is None:
        summary = analog_summary(scan_history(df, tags), start, end, DAY_MS, block_ms=block_ms)
    else:
        summary = summary_of_states(scan_history(states, tags), start, end, DAY_MS)
    return summary.select(
        "tag", "start_ts", "average", "std_dev", "maximum", "percent_good"
    ).orderBy("tag", "start_ts")

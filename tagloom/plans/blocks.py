"""Ordered per-tag work that no single tag can turn into one huge task.

A window partitioned by tag puts all samples of a busy tag into one task. The
patterns here partition by (tag, time block) instead, so a tag holding any
share of the data is spread over as many tasks as it has blocks. What crosses a
block edge is settled on a few rows per (tag, block); the samples themselves
are shuffled once, and no join strategy is forced.

``block_ms`` bounds the rows a task sorts. The default suits tags sampled up
to a few thousand times a second; ``suggest_block_ms`` derives it from the data
for other rates (very sparse tags profit from long blocks).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.time import MS, floor_div
from tagloom.session import ensure

BLOCK_MS = 3_600_000


def block_of(us: Column, block_ms: int) -> Column:
    return floor_div(us, block_ms * MS)


def suggest_block_ms(
    df: DataFrame, ts: str = "ts", key: str = "tag", target_rows: int = 5_000_000
) -> int:
    """Block width that holds about ``target_rows`` of the busiest tag.

    Runs one aggregation (a count per tag and the time span) and returns a
    number; call it once per data set, not once per query.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    per_tag = df.groupBy(key).agg(
        F.count("*").alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi")
    )
    row = per_tag.select(
        F.max(F.col("n") * F.lit(1_000.0) / (F.col("hi") - F.col("lo") + F.lit(MS))).alias("per_ms")
    ).first()
    if row is None or not row.per_ms:
        return BLOCK_MS
    return max(1, int(target_rows / row.per_ms))


def _same(pairs) -> Column:
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in pairs))


def blocked(df: DataFrame, keys: Sequence[str], block_ms: int) -> DataFrame:
    """``df`` with its block number ``_blk``.

    Rows without key or time have no place in an order. Dropping them here also
    keeps the plans that branch off alike, so that they share one shuffle.
    """
    ensure(df.sparkSession)
    if "_blk" not in df.columns:
        df = df.withColumn("_blk", block_of(F.col("us"), block_ms))
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in [*keys, "_blk"]))
    return df.filter(present)


def runs(
    df: DataFrame,
    state: Sequence[str],
    keys: Sequence[str] = ("tag",),
    block_ms: int = BLOCK_MS,
    aggs: dict[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Maximal runs of rows with equal ``state`` per key, in order of ``us``.

    Without ``aggs`` the first row of each run is returned with all its
    columns. With ``aggs``, ``{name: (over rows, over pieces)}``, the result has
    the keys, the state and the aggregates; the second column combines the
    pieces of a run that lies in several blocks and may use ``name`` and ``us``.

    Adds ``end_us``, the first instant of the next run (NULL for the last run),
    and, without ``aggs``, ``first_run``, true for the first run of a key.

    Runs inside a block are final as they stand. Only the first and last run of
    each block are ordered per key, to see which of them go on from the block
    before and where the last one ends.
    """
    keys, state = list(keys), list(state)
    part = ["_blk", *keys]
    # Several rows at one instant are ordered by their other columns, so that
    # every evaluation of the plan sees the same order.
    ties = [c for c in df.columns if c not in (*keys, "us", "_blk")]
    w = Window.partitionBy(*part).orderBy("us", *ties)

    head = F.row_number().over(w) == 1
    changed = ~_same((F.lag(c).over(w), F.col(c)) for c in state)
    marked = blocked(df, keys, block_ms).select("*", head.alias("_head"), changed.alias("_changed"))
    breaks = F.col("_head") | F.col("_changed")

    if aggs is None:
        kept, order = df.columns, ["us", *ties]
        local = marked.filter(breaks)
    else:
        kept, order = [*keys, *state, "us", *aggs], ["us", "_run"]
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        local = (
            marked.withColumn("_run", F.sum(breaks.cast("int")).over(upto))
            .groupBy(*part, "_run", *state)
            .agg(
                F.min("us").alias("us"),
                *[over_rows.alias(name) for name, (over_rows, _) in aggs.items()],
            )
            .withColumn("_head", F.col("_run") == 1)
        )
    following = Window.partitionBy(*part).orderBy(*order)
    local = local.select(
        *kept,
        *[c for c in order if c not in kept],
        "_head",
        F.lead("us").over(following).alias("_next"),
    )
    inside = ~F.col("_head") & F.col("_next").isNotNull()

    inner = local.filter(inside).select(
        *kept, F.col("_next").alias("end_us"), F.lit(False).alias("first_run")
    )
    asc = Window.partitionBy(*keys).orderBy(*order)
    desc = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    later = desc.rowsBetween(Window.unboundedPreceding, -1)
    outer = (
        local.filter(~inside)
        .select(
            "*",
            F.lag("us").over(asc).isNull().alias("first_run"),
            _same((F.lag(c).over(asc), F.col(c)) for c in state).alias("_as_before"),
        )
        .withColumn(
            "_goes_on", F.col("_head") & F.col("_as_before") & ~F.col("first_run")
        )
    )
    # The first change at or after a row: itself, or the next run of its block.
    change = F.when(F.col("_goes_on"), F.col("_next")).otherwise(F.col("us"))
    end = F.coalesce("_next", F.min(change).over(later))

    if aggs is None:
        settled = outer.select(*kept, end.alias("end_us"), "first_run", "_goes_on")
        return inner.unionByName(settled.filter(~F.col("_goes_on")).drop("_goes_on"))

    so_far = asc.rowsBetween(Window.unboundedPreceding, 0)
    began = F.last(F.when(~F.col("_goes_on"), F.col("us")), ignorenulls=True).over(so_far)
    merged = (
        outer.select("*", began.alias("_began"), end.alias("end_us"))
        .groupBy(*keys, *state, "_began")
        .agg(
            F.max("end_us").alias("end_us"),
            *[over_pieces.alias(name) for name, (_, over_pieces) in aggs.items()],
        )
        .withColumnRenamed("_began", "us")
    )
    return inner.drop("first_run").unionByName(merged)


# Children of a node of the summary tree, and its levels above the rows. The nodes of the last level have one parent: with
# hours for positions, two for each year, and for seconds of thirty years a quarter of a million.
FAN, LEVELS = 4096, 1


def tree_neighbours(
    rows: DataFrame,
    keys: Sequence[str],
    position: Column,
    first: str,
    last: dict[str, tuple[Column, Column]],
    order: str,
) -> DataFrame:
    """``rows`` with what the nearest other rows of their key hold, in order of the column ``order``.

    ``position`` numbers the rows' places and never falls as ``order`` rises. Adds ``_next_first``, the column ``first``
    of the next row; ``_opens``, true for the first row; and for each ``name: (value, when)`` in ``last`` the latest value
    before the row for which ``when`` holds.

    An up-sweep combines rows to nodes of FAN positions, and these again; a down-sweep then hands each node what comes
    before and after it. Every window is partitioned by key and parent node, so a task orders at most one node's children
    and a key with any share of the rows is never one task's work. Nodes of a level are FAN times fewer than those below.
    """
    keys, names = list(keys), list(last)
    level = rows.withColumn("_parent", floor_div(position, FAN)).select(
        "*",
        F.col(first).alias("_first"),
        F.col(order).alias("_order"),
        *[F.when(when, value).alias(f"_last_{n}") for n, (value, when) in last.items()],
        *[F.when(when, F.col(order)).alias(f"_at_{n}") for n, (_, when) in last.items()],
    )
    levels = []
    for k in range(LEVELS + 1):
        # One shuffle, read both for the nodes and for those above them.
        levels.append(level.repartition(*keys, "_parent"))
        up = levels[-1].groupBy(*keys, "_parent").agg(
            F.min("_first").alias("_first"),
            F.min("_order").alias("_order"),
            *[F.max_by(f"_last_{n}", f"_at_{n}").alias(f"_last_{n}") for n in names],
            *[F.max(f"_at_{n}").alias(f"_at_{n}") for n in names],
        )
        parent = floor_div(F.col("_node"), FAN) if k < LEVELS - 1 else F.lit(0).cast("long")
        level = up.withColumnRenamed("_parent", "_node").withColumn("_parent", parent)

    def beside(df: DataFrame) -> DataFrame:
        asc = Window.partitionBy(*keys, "_parent").orderBy("_order")
        before = asc.rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*",
            F.lead("_first").over(asc).alias("_next_first"),
            F.lag("_order").over(asc).isNull().alias("_opens"),
            # By time: values may be NULL where ``when`` holds.
            *[F.last(F.when(F.col(f"_at_{n}").isNotNull(), F.struct(f"_last_{n}")), ignorenulls=True).over(before).alias(n) for n in names],
        )

    handed = None
    for k in range(LEVELS, -1, -1):
        here = beside(levels[k])
        if handed is not None:
            above = handed.select(
                *keys,
                F.col("_node").alias("_parent"),
                F.col("_next_first").alias("_next_above"),
                F.col("_opens").alias("_opens_above"),
                *[F.col(n).alias(f"_{n}_above") for n in names],
            )
            here = here.join(above, [*keys, "_parent"]).select(
                *[c for c in here.columns if c not in ("_next_first", "_opens", *names)],
                F.coalesce("_next_first", "_next_above").alias("_next_first"),
                (F.col("_opens") & F.col("_opens_above")).alias("_opens"),
                *[F.coalesce(F.col(n), F.col(f"_{n}_above")).alias(n) for n in names],
            )
        handed = here
    return handed.select(*rows.columns, "_next_first", "_opens", *[F.col(f"{n}._last_{n}").alias(n) for n in names])


def in_order(
    df: DataFrame,
    fill: Sequence[str],
    keys: Sequence[str] = ("tag",),
    tie_break: Sequence[Column] = (),
    marks: dict[str, Column] | None = None,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Forward-fill columns and look ahead, per key in order of ``us``.

    Each column in ``fill`` becomes its last non-NULL value at or before the
    row; ``next_us`` is the time of the next row of the key, NULL on the last.
    ``marks`` are further columns, computed from the row before filling. The
    result has the keys, ``us``, and these.

    A frame that has a ``_blk`` column is taken to be partitioned by it.
    """
    keys = list(keys)
    marks = marks or {}
    part = ["_blk", *keys]
    w = Window.partitionBy(*part).orderBy("us", *tie_break, *fill)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)

    rows = blocked(df, keys, block_ms).select(*part, "us", *fill)
    if "_blk" not in df.columns:
        # One shuffle, read both for the rows and for what each block hands on.
        rows = rows.repartition(*part)
    per_block = rows.groupBy(*part).agg(
        F.min("us").alias("_first_us"),
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("us"))).alias(f"_last_{i}")
            for i, c in enumerate(fill)
        ],
    )
    carry = {f"_carry_{i}": (F.col(f"_last_{i}"), F.col(f"_last_{i}").isNotNull()) for i in range(len(fill))}
    carried = tree_neighbours(per_block, keys, F.col("_blk"), "_first_us", carry, "_blk").select(
        *part, F.col("_next_first"), *carry
    )
    local = rows.select(
        *part,
        "us",
        *[c.alias(name) for name, c in marks.items()],
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in fill],
        F.lead("us").over(w).alias("_next"),
    )
    return local.join(carried, part).select(
        *keys,
        "us",
        *marks,
        *[F.coalesce(F.col(c), F.col(f"_carry_{i}")).alias(c) for i, c in enumerate(fill)],
        F.coalesce("_next", "_next_first").alias("next_us"),
    )

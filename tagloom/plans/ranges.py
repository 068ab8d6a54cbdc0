"""Joins of intervals that overlap, as equal-key joins.

Time is cut into nodes of eight widths on every level: a node of level ``k`` is 8^k microseconds long. An interval belongs to
the level at which it spans a few nodes, and is also entered at those coarser levels that the other side has intervals on. Two
intervals then meet on the coarser of their two levels, and are paired in the node where their overlap begins: each pair
once, found by a hash or merge join on level and node. The widths follow the intervals, so that most rows that meet in a
node do overlap; a fixed width would either copy long intervals many times or pair short ones with all others of their bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels by which intervals are entered finer than their own length: one such interval spans up to 9 nodes.
FINER = 1
#: Rows of the left side in one node above which they are dealt to several tasks.
SPLIT_ROWS = 2_000_000


def _level(begin: str, until: str) -> Column:
    bits = f"CASE WHEN {until} - {begin} <= 1 THEN 0 ELSE length(bin({until} - {begin} - 1)) END"
    return F.expr(f"CAST(greatest(({bits} + 2) DIV 3 - {FINER}, 0) AS INT)")


def _node(us: Column, level: str) -> Column:
    return F.call_function("shiftright", us, F.col(level) * 3)


def _present(df: DataFrame, level: str) -> list[int]:
    """The levels that occur, at most 22."""
    return sorted(r[0] for r in df.select(level).distinct().collect())


def _entered(df: DataFrame, side: str, others: list[int]) -> DataFrame:
    """A row for each level and node an interval is entered at."""
    begin, until, level = f"_{side}_begin", f"_{side}_until", f"_{side}_level"
    coarser = ", ".join(map(str, others)) or "CAST(NULL AS INT)"
    places = f"""flatten(transform(
        array_union(array({level}), filter(array({coarser}), k -> k > {level})),
        k -> transform(sequence(shiftright({begin}, 3 * k), shiftright({until} - 1, 3 * k)),
                       n -> named_struct('_level', k, '_node', n))))"""
    return df.withColumn("_place", F.explode(F.expr(places))).select("*", "_place.*").drop("_place")


def overlapping(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = (),
    left_span: tuple[str, str] = ("us", "until_us"),
    right_span: tuple[str, str] = ("from_us", "to_us"),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose half-open intervals, in microseconds, overlap; the columns of both.

    Intervals that are empty or have a NULL bound, and rows with a NULL key, are in no pair. Apart from ``keys`` the sides'
    columns must differ in name, and none may begin with ``_l_``, ``_r_`` or be called ``_level``, ``_node``, ``_part``.

    The left side should be the one with more rows: its rows in a node are counted, and a node with more than
    ``split_rows`` of them is dealt to several tasks, to each of which the node's right rows are copied. The levels that
    occur, at most 22 on each side, are looked up first.
    """
    keys = list(keys)

    def prepared(df: DataFrame, side: str, span: tuple[str, str]) -> DataFrame:
        begin, until = f"_{side}_begin", f"_{side}_until"
        given = df.withColumn(begin, F.col(span[0])).withColumn(until, F.col(span[1]))
        known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys), F.col(until) > F.col(begin))
        return given.filter(known).withColumn(f"_{side}_level", _level(begin, until))

    ours, theirs = prepared(left, "l", left_span), prepared(right, "r", right_span)
    on_left, on_right = _present(ours, "_l_level"), _present(theirs, "_r_level")
    ours, theirs = _entered(ours, "l", on_right), _entered(theirs, "r", on_left)

    place = [*keys, "_level", "_node"]
    many = (
        ours.groupBy(*place)
        .agg(F.count("*").alias("_parts"))
        .filter(F.col("_parts") > split_rows)
        .withColumn("_parts", F.ceil(F.col("_parts") / split_rows).cast("int"))
    )
    # One row per split_rows entered at most, so it is sent to the tasks and neither side is shuffled for it.
    many = F.broadcast(many)
    parts = F.coalesce("_parts", F.lit(1))
    ours = ours.join(many, place, "left").withColumn("_part", F.pmod(F.xxhash64("_l_begin", "_l_until"), parts).cast("int"))
    theirs = theirs.join(many, place, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    met = ours.drop("_parts").join(theirs.drop("_parts"), [*place, "_part"])
    pairs = met.filter(
        (F.col("_l_begin") < F.col("_r_until"))
        & (F.col("_r_begin") < F.col("_l_until"))
        & (F.col("_level") == F.greatest("_l_level", "_r_level"))
        & (F.col("_node") == _node(F.greatest("_l_begin", "_r_begin"), "_level"))
    )
    return pairs.select(*left.columns, *[c for c in right.columns if c not in keys])

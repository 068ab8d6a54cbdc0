"""Overlap joins against all pairs, and summaries within overlapping intervals."""

import random

import pytest
from conftest import at, sec

from tagloom.operators import intervals
from tagloom.plans import ranges
from tagloom.schemas import HISTORY


def spans(seed, n, keys="ab"):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        begin = rng.randrange(-(10**6), 10**6)
        rows.append((rng.choice(keys), i, begin, begin + rng.choice([0, 1, 2, 7, 8, 9, 100, 5000, 400_000])))
    return rows


@pytest.mark.parametrize("split", [2, 1000])
@pytest.mark.parametrize("keys", [["k"], []])
def test_overlapping(table, keys, split):
    ours, theirs = spans(1, 150), spans(2, 150)
    ours += [(None, 900, 0, 9), ("a", 901, None, 9), ("a", 902, 5, None), ("a", 903, 9, 5), ours[0]]
    left = table(ours, "k string, i int, us long, until_us long")
    right = table(theirs, "k string, j int, from_us long, to_us long")
    if not keys:
        right = right.withColumnRenamed("k", "other")
    got = sorted((r.i, r.j) for r in ranges.overlapping(left, right, keys, split_rows=split).collect())
    expected = sorted(
        (i, j)
        for k, i, a, b in ours
        for m, j, c, d in theirs
        if None not in (a, b) and max(a, c) < min(b, d) and a < b and c < d and (not keys or k == m)
    )
    assert got == expected and len(got) > 400


def test_overlapping_extremes(table):
    """A microsecond meets an interval of centuries, and empty sides give no pairs."""
    left = table([(1, 5, 6), (2, -(2**60), 2**60), (3, 7, 7)], "i int, us long, until_us long")
    right = table([(1, -(2**59), 2**59), (2, 6, 7)], "j int, from_us long, to_us long")
    got = ranges.overlapping(left, right)
    assert sorted((r.i, r.j) for r in got.collect()) == [(1, 1), (2, 1), (2, 2)]
    assert ranges.overlapping(left.limit(0), right).count() == ranges.overlapping(left, right.limit(0)).count() == 0


def test_no_nested_loop(table):
    left = table(spans(1, 50), "k string, i int, us long, until_us long").drop("k")
    right = table(spans(2, 50), "k string, j int, from_us long, to_us long").drop("k")
    plan = ranges.overlapping(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("split", [2, 10_000])
def test_summarise_within(hist, table, split):
    df = hist([("t", -5, 10), ("t", 4, 20), ("t", 8, None, 0), ("t", 10, 40), ("u", 7, 1), ("other", 0, 9)])
    given = [("x", at(0), at(8)), ("x", at(0), at(8)), ("y", at(2), at(12)), ("z", at(100), at(110)), ("open", at(1), None), ("empty", at(3), at(3)), ("before", at(-90), at(-80))]
    within = table(given, "name string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = intervals.summarise_within(df, ["t", "u"], within, at(-10), at(200), split_rows=split).collect()
    seen = {(r.name, r.tag): (r.average, r.minimum, sec(r.min_ts), sec(r.max_ts), r.value_count, round(r.percent_good, 6)) for r in got}
    assert len(got) == len(seen) and seen == {
        ("x", "t"): (15, 10, 0, 4, 1, 100),
        ("x", "u"): (1, 1, 7, 7, 1, 12.5),
        ("y", "t"): ((20 + 80 + 80) / 8, 10, 2, 10, 3, 80),
        ("y", "u"): (1, 1, 7, 7, 1, 50),
        ("z", "t"): (40, 40, 100, 100, 0, 100),
        ("z", "u"): (1, 1, 100, 100, 0, 100),
    }


def test_slices_are_a_case_of_intervals(hist):
    """Within the slices of a tag it gives what slicing by that tag gives."""
    rng = random.Random(3)
    df = hist([("p", s, rng.randrange(3)) for s in range(0, 300, 7)] + [("t", s, rng.choice([1, 2, None])) for s in range(-3, 300, 4)])
    sliced = intervals.slice_by(df, "p", ["t"], at(-1), at(310)).drop("slice_value", "duration_ms")
    again = intervals.summarise_within(df, ["t"], sliced.select("start_ts", "end_ts"), at(-1), at(310))
    names = sliced.columns
    assert sorted(map(str, sliced.collect())) == sorted(map(str, again.select(*names).collect())) and sliced.count() > 20


def test_no_history(spark, table):
    within = table([("x", at(0), at(8))], "name string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    assert intervals.summarise_within(spark.createDataFrame([], HISTORY), ["t"], within, at(0), at(9)).count() == 0


def test_no_side_is_shuffled_for_the_counts(spark, table):
    """The few nodes that are dealt are sent to the tasks whatever Spark expects of their number."""
    left = table(spans(1, 20), "k string, i int, us long, until_us long")
    right = table(spans(2, 20), "k string, j int, from_us long, to_us long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ranges.overlapping(left, right, ["k"])._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1

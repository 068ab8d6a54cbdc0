from datetime import datetime

import pytest
from conftest import at, sec
from pyspark.sql import functions as F

from tagloom.operators import retrieval
from tagloom.sources import history


def test_delta_durations_and_last_row(hist):
    df = hist([("a", 0, 9), ("a", 1, 1), ("a", 2, 1), ("a", 5, 2), ("a", 6, None, 0), ("a", 9, 9)])
    got = retrieval.delta(df, at(0), at(9)).orderBy("ts").collect()
    assert [(sec(r.ts), r.value, r.quality, r.duration_ms) for r in got] == [
        (1, 1, 192, 4000),
        (5, 2, 192, 1000),
        (6, None, 0, None),
    ]


def test_delta_sees_quality_changes_unless_told_otherwise(hist):
    df = hist([("a", 1, 1), ("a", 2, 1, 64), ("a", 3, 1)])
    assert retrieval.delta(df).count() == 3
    assert retrieval.delta(df, on=["value"]).count() == 1


def test_start_bound_is_stamped_at_start(hist):
    df = hist([("a", 1, 1), ("a", 4, 2), ("b", 6, 3), ("c", 5, 4)])
    got = {r.tag: (sec(r.ts), r.value, sec(r.sampled_ts)) for r in history.start_bound(df, at(5)).collect()}
    assert got == {"a": (5, 2, 4), "c": (5, 4, 5)}


def test_live_and_versions(hist, table):
    assert history.live(hist([("a", 1, 1), ("a", 3, None), ("a", 2, 5)])).first().value is None
    rows = [("a", at(1), 1.0, 1), ("a", at(1), 2.0, 3), ("a", at(2), 7.0, 0)]
    df = table(rows, "tag string, ts timestamp_ntz, value double, version int")
    got = {(sec(r.ts), r.value) for r in history.latest_version(df).collect()}
    assert got == {(1, 2.0), (2, 7.0)}


def test_cyclic_holds_values_and_is_null_before_the_first(hist):
    df = hist([("a", 12, 1), ("a", 20, 2), ("a", 41, 3), ("b", -5, 8), ("b", 15, None)])
    got = retrieval.cyclic(df, at(0), at(50), resolution_ms=10_000).orderBy("tag", "ts").collect()
    a = [(sec(r.ts), r.value) for r in got if r.tag == "a"]
    b = [(sec(r.ts), r.value) for r in got if r.tag == "b"]
    assert a == [(0, None), (10, None), (20, 2), (30, 2), (40, 2)]
    assert b == [(0, 8), (10, 8), (20, None), (30, None), (40, None)]
    assert retrieval.cyclic(df, at(0), at(50), cycles=2).count() == 4


@pytest.mark.parametrize("width", [1000, 3_600_000])
def test_edges(hist, width):
    df = hist([("a", 1, 9), ("a", 2, 9), ("a", 3, 1), ("a", 4, None), ("a", 5, 9), ("b", 3, 1), ("b", 4, 9)])
    hot = F.col("value") > 5

    def edges(mode, start=None):
        got = retrieval.edges(df, hot, mode, start, at(10), block_ms=width).collect()
        return sorted((r.tag, sec(r.ts), r.edge) for r in got)

    assert edges("leading") == [("a", 1, "leading"), ("a", 5, "leading"), ("b", 4, "leading")]
    assert edges("trailing") == [("a", 3, "trailing")]
    assert len(edges("both")) == 4
    # The sample before the range decides whether the first one is an edge.
    assert edges("leading", at(2)) == [("a", 5, "leading"), ("b", 4, "leading")]
    with pytest.raises(ValueError):
        edges("rising")


@pytest.mark.parametrize("width", [1000, 3_600_000])
def test_wide(hist, width):
    df = hist(
        [("a b", -3, 1), ("a b", 2, 0), ("c", 2, 5), ("c", 4, None, 0), ("c", 6, None, 0), ("c", 8, 1)]
    )
    got = retrieval.wide(df, ["a b", "c"], at(0), at(8), block_ms=width).orderBy("ts").collect()
    assert [(sec(r.ts), r["a b"], r["c"], r.duration_ms) for r in got] == [
        (0, 1, None, 2000),
        (2, 0, 5, 2000),
        (4, 0, None, 4000),
        (8, 0, 1, None),
    ]


def test_scan_and_tag_list(hist, table):
    df = hist([("a", 1, 1), ("b", 1, 1), ("c", 1, 1)])
    assert {r.tag for r in history.scan_history(df, ["a", "c"]).collect()} == {"a", "c"}
    listed = history.for_tags(df, table([("b",), ("b",), (None,)], "tag string"))
    assert [r.tag for r in listed.collect()] == ["b"]


def test_time_zone(table):
    df = table([(datetime(2024, 7, 1, 12),)], "ts timestamp_ntz")
    assert history.in_time_zone(df, "America/New_York").first().ts == datetime(2024, 7, 1, 8)


def test_append_and_read_back(spark, hist, tmp_path):
    path = str(tmp_path / "h")
    history.append_samples(hist([("a", 1, 1)]), path)
    history.append_samples(hist([("a", 90_000, None, 0)]), path)
    df = history.read_history(spark, path)
    assert sorted((sec(r.ts), r.value, r.quality) for r in df.collect()) == [
        (1, 1.0, 192),
        (90_000, None, 0),
    ]


def test_days_are_pruned(spark, hist, tmp_path):
    path = str(tmp_path / "h")
    history.append_samples(hist([("a", 86400 * d, d) for d in range(5)]), path)
    df = history.scan_history(history.read_history(spark, path), None, at(86400), at(3 * 86400))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    assert sorted(r.value for r in df.collect()) == [1, 2]


def test_snapshot_replaces_earlier_samples(hist):
    from tagloom.operators.summary import analog_summary

    df = hist([("a", t, t % 7) for t in range(0, 100, 3)] + [("b", 5, 1), ("c", 40, 2), ("d", 90, 3)])
    stored = history.snapshot(df, at(40))
    assert stored.count() == 3
    short = history.from_snapshot(df, stored, at(40))
    for start in (40, 55):
        a, b = (
            sorted(map(str, analog_summary(x, at(start), at(100), 9000).collect())) for x in (df, short)
        )
        assert a == b
        a, b = (
            sorted(map(str, retrieval.edges(x, F.col("value") > 3, "both", at(start + 1), at(100)).collect()))
            for x in (df, short)
        )
        assert a == b

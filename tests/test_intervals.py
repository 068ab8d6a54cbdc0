import pytest
from conftest import at, sec
from pyspark.sql import functions as F

from tagloom.operators import intervals

WIDTHS = [1000, 3_600_000]


@pytest.mark.parametrize("width", WIDTHS)
def test_slice_by(hist, width):
    df = hist(
        [("phase", 0, 1), ("phase", 10, 1), ("phase", 12, 2), ("phase", 20, None, 0), ("phase", 24, 1),
         ("t", -3, 100), ("t", 12, 50), ("t", 16, 10), ("t", 22, None, 0), ("t", 30, 1), ("u", 21, 7)]
    )
    got = intervals.slice_by(df, "phase", ["t", "u"], at(-1), at(40), block_ms=width).collect()
    rows = {
        (r.tag, sec(r.start_ts), sec(r.end_ts), r.slice_value): (r.average, r.duration_ms, r.value_count)
        for r in got
    }
    assert rows == {
        ("t", 0, 12, "1.0"): (100, 12000, 0),
        ("t", 12, 20, "2.0"): (30, 8000, 2),
        ("t", 20, 24, None): (10, 4000, 1),
        ("u", 0, 12, "1.0"): (None, 12000, 0),
        ("u", 12, 20, "2.0"): (None, 8000, 0),
        ("u", 20, 24, None): (7, 4000, 1),
    }


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("shift", [0, -64 * 365 * 86400])
def test_slices_before_1970(hist, width, shift):
    df = hist([("p", shift + s, v) for s, v in ((1, 1), (5, 2), (9, 3))] + [("t", shift, 4)])
    got = intervals.slice_by(df, "p", ["t"], at(shift), at(shift + 20), block_ms=width).collect()
    assert [(sec(r.start_ts) - shift, sec(r.end_ts) - shift, r.average) for r in sorted(got)] == [(1, 5, 4), (5, 9, 4)]


@pytest.mark.parametrize("width", WIDTHS)
def test_slices_by_text(hist, width):
    df = hist([("p", s, 0) for s in (1, 2, 5, 7, 9)] + [("t", 0, 4), ("t", 6, 8)])
    phase = F.when(df["ts"] < F.lit(at(5)), "fill").when(df["ts"] < F.lit(at(7)), "").when(df["ts"] > F.lit(at(8)), "drain")
    got = intervals.slice_by(df.withColumn("phase", phase), "p", ["t"], at(0), at(20), block_ms=width, slice_value="phase").collect()
    assert [(sec(r.start_ts), sec(r.end_ts), r.slice_value, r.average) for r in sorted(got)] == [(1, 5, "fill", 4), (5, 7, "", 6), (7, 9, None, 8)]


@pytest.mark.parametrize("width", WIDTHS)
def test_slices_start_after_the_window_opens(hist, width):
    df = hist([("p", 0, 1), ("p", 5, 2), ("p", 9, 3), ("t", 0, 1)])
    got = intervals.slice_by(df, "p", ["t"], at(0), at(9), block_ms=width).collect()
    # Only the change at 5 lies in the open window, and its run has no end.
    assert got == []


@pytest.mark.parametrize("width", WIDTHS)
def test_threshold_extrema(hist, width):
    df = hist(
        [("a", -5, 99), ("a", 3, 95), ("a", 5, 50), ("a", 6, 8), ("a", 7, 2), ("a", 8, 91), ("a", 9, 97),
         ("a", 11, None, 0), ("a", 12, 95), ("a", 13, 96)]
    )
    got = intervals.threshold_extrema(df, "a", 10, 90, at(0), at(20), block_ms=width).orderBy("start_ts").collect()
    assert [
        (sec(r.start_ts), sec(r.end_ts), r.edge, r.minimum, sec(r.min_ts), r.maximum, sec(r.max_ts),
         r.duration_ms, r.value)
        for r in got
    ] == [
        (0, 5, "Max", 95, 3, 99, 0, 5000, 99),
        (6, 8, "Min", 2, 7, 8, 6, 2000, 8),
        (8, 11, "Max", 91, 8, 97, 9, 3000, 91),
    ]


@pytest.mark.parametrize("width", WIDTHS)
def test_incidents(spark, hist, width):
    df = hist(
        [("cpu", -2, 99), ("cpu", 1, 98), ("cpu", 2, 10), ("cpu", 4, 97), ("cpu", 5, None, 0), ("cpu", 8, 96),
         ("mem", 3, 400), ("mem", 6, 600)]
    )
    rules = [("cpu", ">", 95), ("mem", "<", 500), ("cpu", ">", 95)]
    got = intervals.incidents(df, rules, at(0), at(10), block_ms=width).collect()
    assert [(sec(r.start_ts), sec(r.end_ts), r.tag, r.value, r.duration_ms) for r in got] == [
        (3, 6, "mem", 400, 3000),
        (4, 5, "cpu", 97, 1000),
        (8, None, "cpu", 96, None),
    ]


def test_rules_reach_the_scan_without_a_join(spark, tmp_path, hist):
    hist([("cpu", 1, 96), ("other", 1, 1)]).write.parquet(str(tmp_path / "h"))
    df = spark.read.parquet(str(tmp_path / "h"))
    plan = intervals.incidents(df, [("cpu", ">", 95), ("mem", "<", 5)], at(0), at(10))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    filters = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert filters and all("In(tag, [cpu,mem])" in line for line in filters)


def test_capacity_rules(spark):
    got = set(intervals.capacity_rules("m", "c", 8, 2))
    assert got == {("m", ">", 950.0), ("c", ">", 95.0 / 8 * 2)}


@pytest.mark.parametrize("width", WIDTHS)
def test_any_all(hist, width):
    df = hist(
        [("a", -1, 0), ("b", -1, 0), ("c", -1, 0), ("a", 2, 1), ("b", 2, 1), ("c", 3, 1), ("b", 5, None, 0),
         ("b", 6, 0), ("a", 8, 0), ("c", 9, 0)]
    )
    r = intervals.any_all(df, ["a", "b", "c"], at(0), at(10), block_ms=width).first()
    assert (sec(r.start_ts), sec(r.end_ts)) == (0, 9)
    assert (r.none_ms, r.all_ms, r.any_ms) == (2000, 2000, 1000 + 2000 + 2000 + 1000)
    assert (r.none_count, r.all_count, r.any_count) == (2, 1, 4)
    assert (r.change_count, r.not_final) == (7, 1)
    assert r.all_ms <= r.any_ms


def test_thousands_of_rules(hist, monkeypatch):
    rules = [(f"t{k}", op, float(k % 7)) for k in range(3000) for op in (">", "<=")] + [("t5", ">", 5.0)]
    df = hist([(f"t{k}", s, k % 11) for k in range(2990, 3010) for s in (1, 2)])

    def attached():
        return sorted((r.tag, r.ts, r.value, r.op, r.limit) for r in intervals.with_rules(df, rules).collect())

    got = attached()
    assert len(got) == 10 * 2 * 2 and all(r[4] == int(r[0][1:]) % 7 for r in got)
    monkeypatch.setattr(intervals, "RULES_SENT", 10)
    assert attached() == got
    assert intervals.with_rules(df, []).count() == 0

import math
import random

import pytest
from conftest import at, sec
from pyspark.sql import functions as F

from tagloom.operators import summary


def plain_summary(samples, lo, hi, width):
    """(cycle -> statistics) of one tag's (seconds, value) samples, by the second."""
    out = {}
    before = [s for s in samples if s[0] <= lo]
    rows = ([(lo, before[-1][1], before[-1][0] < lo)] if before else []) + [
        (t, v, False) for t, v in samples if lo < t < hi
    ]
    for c in range(math.ceil((hi - lo) / width)):
        a, b = lo + c * width, min(lo + (c + 1) * width, hi)
        pieces = []
        for i, (t, v, _) in enumerate(rows):
            until = rows[i + 1][0] if i + 1 < len(rows) else hi
            x, y = max(t, a), min(until, b)
            if y > x:
                pieces.append((x, y - x, v))
        good = [p for p in pieces if p[2] is not None]
        w = sum(p[1] for p in good)
        area = sum(p[1] * p[2] for p in good)
        mean = area / w if w else None
        lowest = min(((p[2], p[0]) for p in good), default=(None, None))
        highest = min(((-p[2], p[0]) for p in good), default=(None, None))
        out[c] = (
            *lowest,
            None if highest[0] is None else -highest[0],
            highest[1],
            mean,
            math.sqrt(max(0.0, sum(p[1] * p[2] ** 2 for p in good) / w - mean**2)) if w else None,
            area if good else None,
            sum(1 for t, _, carried in rows if not carried and a <= t < b),
            100.0 * w / (b - a),
        )
    return out


@pytest.mark.parametrize("width", [1000, 4000, 3_600_000])
@pytest.mark.parametrize("cycle", [7, 10, 60])
def test_analog_summary_against_plain_loop(hist, width, cycle):
    rng = random.Random(cycle)
    rows = {}
    for tag, n, span in (("busy", 65, (-10, 60)), ("late", 4, (31, 59)), ("early", 3, (-9, 0)), ("edge", 6, (0, 60))):
        for t in rng.sample(range(*span), n):
            rows[(tag, t)] = rng.choice([1.0, 2.0, 5.0, None])
    rows = {k: v for k, v in rows.items()} | {("edge", 0): 4.0}
    df = hist([(tag, t, v, 192 if v is not None else 0) for (tag, t), v in rows.items()])
    got = summary.analog_summary(df, at(0), at(60), cycle * 1000, block_ms=width).collect()
    seen = {}
    for r in got:
        seen.setdefault(r.tag, {})[int(sec(r.start_ts)) // cycle] = (
            r.minimum, sec(r.min_ts), r.maximum, sec(r.max_ts), r.average, r.std_dev, r.integral,
            r.value_count, r.percent_good,
        )
    for tag in {k[0] for k in rows}:
        expected = plain_summary(sorted((t, v) for (g, t), v in rows.items() if g == tag), 0, 60, cycle)
        assert seen[tag].keys() == expected.keys()
        for c, values in expected.items():
            assert seen[tag][c] == pytest.approx(values, abs=1e-6), (tag, c)


def test_summary_carry_in_split_bad_and_empty(hist):
    """Three samples, one before the window, one bad; the last cycle has none."""
    df = hist([("a", -5, 10), ("a", 5, 20, 64), ("a", 15, 30)])
    got = summary.analog_summary(df, at(0), at(30), 10_000).orderBy("start_ts").collect()
    assert [(r.average, r.percent_good, r.value_count) for r in got] == [
        (10, 50, 1),
        (30, 50, 1),
        (30, 100, 0),
    ]
    assert got[2].minimum == 30 and sec(got[2].min_ts) == 20


def test_cycle_integrals_add_up(hist):
    rng = random.Random(3)
    df = hist([("a", t, rng.random()) for t in rng.sample(range(0, 100), 60)])
    parts = summary.analog_summary(df, at(0), at(100), cycles=8, block_ms=5000).agg(F.sum("integral")).first()[0]
    whole = summary.full_summary(df, at(0), at(100)).first().integral
    assert parts == pytest.approx(whole)


@pytest.mark.parametrize("width", [1000, 3_600_000])
def test_state_summary(hist, width):
    df = hist([("a", -5, 1), ("a", 4, 0), ("a", 6, 0), ("a", 8, 1), ("a", 9, 0), ("a", 12, None, 0)])
    got = summary.state_summary(df, at(0), at(20), 10_000, block_ms=width).collect()
    rows = {(sec(r.start_ts), r.state): (r.state_count, r.state_ms, r.min_contained_ms, r.max_contained_ms) for r in got}
    assert rows == {
        (0, 1.0): (2, 5000, 1000, 1000),
        (0, 0.0): (2, 5000, 4000, 4000),
        (10, 0.0): (1, 2000, None, None),
        (10, None): (1, 8000, None, None),
    }
    assert sum(r.state_percent for r in got) == pytest.approx(200)


def test_states_fill_the_window(hist):
    rng = random.Random(5)
    df = hist([("a", t, rng.choice([0, 1, 2])) for t in [0, *rng.sample(range(1, 500), 100)]])
    got = summary.state_summary(df, at(0), at(500), cycles=7, block_ms=9000)
    assert got.agg(F.sum("state_ms")).first()[0] == pytest.approx(500_000, abs=20)


def test_missing_states_are_zero(hist, table):
    """A half hour in which one tag pulses 15 times for a minute, the other never."""
    pulses = [("pulse", 60 * i, 1 - i % 2) for i in range(30)]
    df = hist([*pulses, ("hour", -100, 0)])
    tags = table([("hour",), ("pulse",), ("absent",)], "tag string")
    got = summary.state_summary_filled(df, tags, 1.0, at(0), at(1800)).collect()
    assert {r.tag: (r.state_count, r.state_ms) for r in got} == {
        "hour": (0, 0),
        "pulse": (15, 900_000),
        "absent": (0, 0),
    }


def test_hour_of_day(hist):
    df = hist([("a", 86400 * d + 3600 * h, d + h) for d in range(3) for h in range(24)])
    got = summary.hour_of_day(df, at(3 * 86400), days=4).collect()
    assert len(got) == 24
    five = next(r for r in got if r.hour_of_day == 5)
    assert (five.minimum, five.maximum, five.average, five["count"]) == (5, 7, 6, 3)
    assert five.std_dev == pytest.approx(math.sqrt(2 / 3))
    assert sec(five.ts) == 2 * 86400 + 5 * 3600
    fixed = summary.hour_of_day(df, at(3 * 86400 + 60), days=4, mode="fixed").collect()
    assert sec(next(r for r in fixed if r.hour_of_day == 5).ts) == 3 * 86400 + 5 * 3600
    with pytest.raises(ValueError):
        summary.hour_of_day(df, at(0), mode="sliding")


def test_resource_report_layout(hist):
    df = hist([("cpu", 0, 10), ("cpu", 30, 20), ("pending", 0, 0), ("pending", 10, 1), ("pending", 20, 0), ("pending", 24, 1)])
    got = {r.tag: r for r in summary.resource_report(df, ["cpu", "cpu"], ["pending"], 0, at(0), at(60)).collect()}
    assert set(got) == {"cpu", "pending (0)"}
    assert (got["cpu"].average, got["cpu"].range, got["cpu"].percent_good) == (15, 10, 100)
    state = got["pending (0)"]
    assert (state.average, state.minimum, state.maximum, state.std_dev, state.range) == (7000, 4000, 10000, 2, None)


def test_daily_load(hist):
    df = hist([("a", 0, 1), ("a", 43_200, 3), ("b", 0, 1)])
    got = summary.daily_load(df, ["a"], at(86400 + 5), days=1).collect()
    assert [(r.tag, r.average, r.maximum) for r in got] == [("a", 2, 3)]


def test_cycles_must_have_length():
    from tagloom.plans.cycles import Cycles

    for kw in ({"resolution_ms": 0}, {"cycles": 0}, {"resolution_ms": 5, "cycles": 2}):
        with pytest.raises(ValueError):
            Cycles.of(at(0), at(1), **kw)
    with pytest.raises(ValueError):
        Cycles.of(at(1), at(1))
    grid = Cycles.of(at(0), at(10), cycles=3)
    assert (grid.width_us, grid.count) == (3_333_333, 3)

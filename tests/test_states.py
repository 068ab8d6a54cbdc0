"""Kept summary states give what the samples give, also after late samples and broken appends."""

import random
from datetime import timedelta

import pytest
from conftest import T0, at

from tagloom.operators import summary
from tagloom.schemas import HISTORY
from tagloom.sources import history, states

HOUR, DAY = 3600, 86400


def some(seed, n=300, days=5):
    rng = random.Random(seed)
    times = rng.sample(range(days * DAY // 60), n)
    return [(rng.choice("abb"), t * 60, rng.choice([1, 5, 9, None, float("nan")][:4]), rng.choice([192, 192, 0])) for t in times]


def shown(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "history"), str(tmp_path / "states")


@pytest.mark.parametrize("hours", [1, 5, 24])
def test_late_samples(spark, hist, folders, hours):
    rows = some(1) + [("c", -2 * DAY, 4), ("c", 4 * DAY + 5, 2), ("d", 2 * DAY, 3)]
    late = [r for r in rows if r[1] % 7 == 0]
    for part in ([r for r in rows if r[1] % 7], late):
        states.append_with_states(hist(part), *folders)
    kept = states.read_states(spark, *folders)
    # The range begins on a sample of d, behind others of a, b and c.
    start, end = at(2 * DAY), at(4 * DAY + 7 * HOUR)
    expected = summary.analog_summary(hist(rows), start, end, hours * HOUR * 1000)
    got = summary.summary_of_states(kept, start, end, hours * HOUR * 1000)
    assert got.columns == expected.columns
    assert shown(got) == shown(expected) and expected.count() >= 4 * 55 // hours - 4


def test_profiles(spark, hist, folders):
    df = hist(some(2))
    states.append_with_states(df, *folders)
    kept = states.read_states(spark, *folders)
    now = T0 + timedelta(days=4, hours=6, minutes=20)
    for mode in ("rolling", "fixed"):
        assert shown(summary.hour_of_day(None, now, 4, mode, states=kept)) == shown(summary.hour_of_day(df, now, 4, mode))
    assert shown(summary.daily_load(None, ["b"], now, 3, states=kept)) == shown(summary.daily_load(df, ["b"], now, 3))


def test_only_touched_days_are_written(spark, hist, folders, tmp_path):
    states.append_with_states(hist(some(3)), *folders)

    def files():
        return {f.parent.name: {f.name for f in f.parent.glob("*.parquet")} for f in (tmp_path / "states/hours").glob("day=*/*.parquet")}

    before = files()
    states.append_with_states(hist([("a", DAY + 1, 8)]), *folders)
    after = files()
    assert [d for d in before if before[d] != after[d]] == ["day=2024-01-02"]


@pytest.mark.parametrize("step", ["append_samples", "refresh_states"])
def test_an_append_that_dies(spark, hist, folders, monkeypatch, step):
    states.append_with_states(hist([("a", 0, 1), ("a", DAY, 2)]), *folders)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(states, step, die)
        with pytest.raises(RuntimeError):
            states.append_with_states(hist([("a", HOUR, 7)]), *folders)

    def agrees():
        df = history.read_history(spark, folders[0])
        got = summary.summary_of_states(states.read_states(spark, *folders), at(0), at(2 * DAY), HOUR * 1000)
        return shown(got) == shown(summary.analog_summary(df, at(0), at(2 * DAY), HOUR * 1000))

    assert agrees()
    # The next append, of another day, also mends the one that was left.
    states.append_with_states(hist([("a", 3 * DAY, 3)]), *folders)
    assert agrees() and states._pending(spark, folders[1]) == set()


def test_before_1970_and_empty(spark, hist, folders):
    back = -64 * 365 * DAY
    df = hist([("a", back + 10, 2), ("a", back + 5000, 6), (None, back, 1)])
    states.append_with_states(spark.createDataFrame([], HISTORY), *folders)
    states.append_with_states(df, *folders)
    kept = states.read_states(spark, *folders)
    expected = summary.analog_summary(df.filter("tag IS NOT NULL"), at(back), at(back + 4 * HOUR), HOUR * 1000)
    assert shown(summary.summary_of_states(kept, at(back), at(back + 4 * HOUR), HOUR * 1000)) == shown(expected)
    with pytest.raises(ValueError):
        summary.summary_of_states(kept, at(back), at(back + HOUR), 1000)


def test_samples_are_not_read(spark, hist, folders):
    states.append_with_states(hist(some(4)), *folders)
    kept = states.read_states(spark, *folders)
    files = summary.hour_of_day(None, at(4 * DAY), 3, states=kept).inputFiles()
    assert files and all("/states/hours/" in f for f in files)

"""The as-of index: the same answers as from all of history, whatever was appended when."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tagloom.operators import intervals, retrieval, summary
from tagloom.sources import asof, history

from conftest import at

DAY = 86_400


def samples(seed, days, n=150):
    rng = random.Random(seed)
    rows = {(rng.choice("aab"), rng.randrange(days[0] * DAY, days[1] * DAY, 7200)): None for _ in range(n)}
    rows[("rare", days[0] * DAY + 60)] = None
    return [(tag, s, rng.choice([None, 1.0, 2.0, 5.0]), rng.choice([192, 192, 0])) for tag, s in sorted(rows)]


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("every", [1, 3])
def test_answers_after_appends_and_late_samples(spark, hist, tmp_path, every):
    path, index = f"{tmp_path}/history", f"{tmp_path}/index"
    everything = []
    for seed, days in ((1, (3, 8)), (2, (8, 12)), (3, (5, 6)), (4, (0, 2))):  # the last two come late
        rows = [r for r in samples(seed, days) if (r[0], r[1]) not in {(x[0], x[1]) for x in everything}]
        everything += rows
        asof.append_indexed(hist(rows), path, index, every)
        start = at(5.5 * DAY)
        assert same(history.start_bound(asof.read_since(spark, path, index, start), start), history.start_bound(hist(everything), start))
    start, end, hot = at(9 * DAY), at(12 * DAY), F.col("value") > 1
    part, whole = asof.read_since(spark, path, index, start), hist(everything)
    assert part.count() < whole.count() / 2
    assert same(summary.analog_summary(part, start, end, cycles=3), summary.analog_summary(whole, start, end, cycles=3))
    assert same(retrieval.edges(part, hot, "both", start, end), retrieval.edges(whole, hot, "both", start, end))
    assert same(intervals.slice_by(part, "a", ["b"], start, end), intervals.slice_by(whole, "a", ["b"], start, end))
    with pytest.raises(ValueError):
        asof.append_indexed(hist(everything[:1]), path, index, every + 1)


def test_only_later_days_are_read(spark, hist, tmp_path):
    path, index = f"{tmp_path}/history", f"{tmp_path}/index"
    asof.append_indexed(hist(samples(5, (0, 20))), path, index)
    rows = summary.analog_summary(asof.read_since(spark, path, index, at(18 * DAY)), at(18 * DAY), at(19 * DAY), cycles=1)
    scans = spark.createDataFrame(rows._jdf.queryExecution().executedPlan().toString().splitlines(), "string")
    filters = [r[0] for r in scans.filter("value LIKE '%PartitionFilters%'").collect()]
    assert any("day" in x and "> 2024-01-18" in x for x in filters) and any("at" in x and "= 2024-01-18" in x for x in filters)
    days = {r[0] for r in asof.read_since(spark, path, index, at(18 * DAY)).filter("tag <> 'rare'").select(F.to_date("ts")).distinct().collect()}
    assert min(days) >= date(2024, 1, 1) + timedelta(days=10)


def test_an_interrupted_append_leaves_results_right(spark, hist, tmp_path, monkeypatch):
    path, index = f"{tmp_path}/history", f"{tmp_path}/index"
    first, late = samples(6, (0, 9)), [("b", 4 * DAY + 1, 77.0, 192), ("new", 4 * DAY + 1, 78.0, 192)]
    asof.append_indexed(hist(first), path, index)
    monkeypatch.setattr(asof, "extend_index", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        asof.append_indexed(hist(late), path, index)
    monkeypatch.undo()
    for again in (False, True):
        if again:
            asof.extend_index(spark, path, index)
        for day in (3, 5, 8, 9):
            part = asof.read_since(spark, path, index, at(day * DAY))
            assert same(history.start_bound(part, at(day * DAY)), history.start_bound(hist(first + late), at(day * DAY)))


def test_empty_and_before_the_first_link(spark, hist, tmp_path):
    path, index = f"{tmp_path}/history", f"{tmp_path}/index"
    asof.append_indexed(hist([]), path, index)
    asof.append_indexed(hist([("a", DAY, 1.0)]), path, index)
    assert asof.read_since(spark, path, index, at(0)).count() == 1
    assert asof.read_since(spark, path, index, at(90 * DAY)).collect()[0]["value"] == 1.0

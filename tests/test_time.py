from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagloom.functions import time as tm


@pytest.mark.parametrize(
    "unit, a, b, n",
    [
        ("hour", "2024-01-01 00:59:59", "2024-01-01 01:00:00", 1),
        ("hour", "2024-01-01 01:00:00", "2024-01-01 01:59:59", 0),
        ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("minute", "2024-01-01 00:00:59", "2024-01-01 00:02:00", 2),
        ("second", "2024-01-01 00:00:05.9", "2024-01-01 00:00:04.1", -1),
        ("month", "2023-12-31", "2024-02-01", 2),
        ("year", "2023-12-31", "2024-01-01", 1),
        ("day", "1969-12-31 12:00:00", "1970-01-01 12:00:00", 1),
        ("millisecond", "2024-01-01 00:00:00.0009", "2024-01-01 00:00:00.0011", 1),
    ],
)
def test_boundary_diff_counts_boundaries(spark, unit, a, b, n):
    d = tm.boundary_diff(unit, tm.ts_lit(a), tm.ts_lit(b))
    assert spark.range(1).select(d).first()[0] == n


def test_unknown_unit():
    with pytest.raises(ValueError):
        tm.boundary_diff("fortnight", F.lit(1), F.lit(2))


def test_floor_time_counts_from_reference(spark):
    got = spark.range(1).select(tm.floor_time(tm.ts_lit("2024-01-01 00:01:59.5"), 60)).first()[0]
    assert got == datetime(2024, 1, 1, 0, 1)
    got = spark.range(1).select(tm.floor_time(tm.ts_lit("2014-12-31 23:59:59"), 60)).first()[0]
    assert got == datetime(2014, 12, 31, 23, 59)


def test_floor_div_rounds_down(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,)], "x bigint")
    assert [r[0] for r in df.select(tm.floor_div(F.col("x"), 10)).collect()] == [-1, 0, 0, 1]


def test_round_trip_and_shift(spark):
    moment = "2024-03-31 02:30:00.123456"
    row = spark.range(1).select(
        tm.instant(tm.micros(tm.ts_lit(moment))), tm.shift(tm.ts_lit(moment), days=1, minutes=-30)
    ).first()
    assert row[0] == datetime.fromisoformat(moment)
    assert row[1] == datetime(2024, 4, 1, 2, 0, 0, 123456)


def test_bounds(hist):
    df = hist([("a", s, s) for s in range(4)])
    for bounds, expected in [("()", [1, 2]), ("[)", [0, 1, 2]), ("(]", [1, 2, 3]), ("[]", [0, 1, 2, 3])]:
        test = tm.between_ts(F.col("ts"), "2024-01-01 00:00:00", "2024-01-01 00:00:03", bounds)
        assert sorted(r.value for r in df.filter(test).collect()) == expected
    with pytest.raises(ValueError):
        tm.between_ts(F.col("ts"), None, None, "<>")


def test_time_filter_reaches_the_scan(spark, hist, tmp_path):
    hist([("a", s, s) for s in range(4)]).write.parquet(str(tmp_path / "h"))
    df = spark.read.parquet(str(tmp_path / "h"))
    plan = df.filter(tm.between_ts(F.col("ts"), "2024-01-01 00:00:01", None))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text

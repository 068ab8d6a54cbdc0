"""Runs and ordered fills against a plain loop, for any block width."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.plans import blocks
from tagloom.plans.blocks import in_order, runs, suggest_block_ms

WIDTHS = [1, 7, 50, 10_000]


def sample_rows(seed: int, n: int = 120, keys=("a", "b", "c")):
    """Random samples; key ``a`` holds most of them, states repeat and are often NULL."""
    rng = random.Random(seed)
    rows, used = [], set()
    while len(rows) < n:
        key = rng.choices(keys, [6, 2, 1])[0]
        us = rng.randrange(-40_000, 400_000, 500)
        if (key, us) not in used:
            used.add((key, us))
            rows.append((key, us, rng.choice([0.0, 0.0, 0.0, 1.0, None]), rng.randrange(100)))
    return rows


def plain_runs(rows):
    out = []
    for key in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        groups = []
        for r in mine:
            if groups and groups[-1][0][2] == r[2]:
                groups[-1].append(r)
            else:
                groups.append([r])
        for i, g in enumerate(groups):
            end = groups[i + 1][0][1] if i + 1 < len(groups) else None
            out.append((g, end, i == 0))
    return out


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, "tag string, us bigint, state double, x int")


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs(frame, width, seed):
    rows = sample_rows(seed)
    got = runs(frame(rows), ["state"], block_ms=width).collect()
    expected = [(*g[0], end, first) for g, end, first in plain_runs(rows)]
    assert sorted(map(str, ((*r[:4], r.end_us, r.first_run) for r in got))) == sorted(
        map(str, expected)
    )


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed", [4, 5])
def test_runs_with_aggregates(frame, width, seed):
    rows = sample_rows(seed)
    got = runs(
        frame(rows),
        ["state"],
        block_ms=width,
        aggs={
            "n": (F.count("*"), F.sum("n")),
            "low": (F.min("x"), F.min("low")),
            "opening": (F.min_by("x", "us"), F.min_by("opening", "us")),
        },
    ).collect()
    expected = [
        (g[0][0], g[0][2], g[0][1], end, len(g), min(r[3] for r in g), g[0][3])
        for g, end, _ in plain_runs(rows)
    ]
    assert sorted(
        str((r.tag, r.state, r.us, r.end_us, r.n, r.low, r.opening)) for r in got
    ) == sorted(map(str, expected))


@pytest.mark.parametrize("width", WIDTHS)
def test_one_state_across_many_blocks_is_one_run(frame, width):
    rows = [("a", us, 1.0, 0) for us in range(0, 200_000, 1000)] + [("a", 200_000, 2.0, 0)]
    got = sorted((r.us, r.end_us) for r in runs(frame(rows), ["state"], block_ms=width).collect())
    assert got == [(0, 200_000), (200_000, None)]


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("keys", [("tag",), ()])
def test_in_order(spark, monkeypatch, width, keys):
    monkeypatch.setattr(blocks, "FAN", 5)
    rng = random.Random(9)
    rows = [
        (rng.choice("aab"), us, rng.choice([None, None, float(us)]), rng.choice([None, us]))
        for us in range(0, 300_000, 3_000)
    ]
    df = spark.createDataFrame(rows, "tag string, us bigint, v double, w bigint")
    marks = {"seen": F.col("v").isNotNull()}
    got = in_order(df, ["v", "w"], keys=keys, marks=marks, block_ms=width).collect()
    expected = []
    for key in sorted({r[0] for r in rows}) if keys else [None]:
        mine = [r for r in rows if key is None or r[0] == key]
        v = w = None
        for i, r in enumerate(mine):
            v = r[2] if r[2] is not None else v
            w = r[3] if r[3] is not None else w
            after = mine[i + 1][1] if i + 1 < len(mine) else None
            expected.append((r[1], r[2] is not None, v, w, after))
    assert sorted(map(str, ((r.us, r.seen, r.v, r.w, r.next_us) for r in got))) == sorted(
        map(str, expected)
    )


@pytest.mark.parametrize("width", [1, 10_000])
def test_rows_at_one_instant_are_neither_lost_nor_doubled(frame, width):
    rows = [("a", us, float(i % 2), i) for us in range(0, 20_000, 1000) for i in range(4)]
    got = runs(frame(rows), ["state"], block_ms=width).collect()
    # Ordered 0, 0, 1, 1 at each instant: two changes each time.
    assert sorted((r.us, r.state) for r in got) == sorted((us, s) for us in range(0, 20_000, 1000) for s in (0.0, 1.0))
    assert sum(r.end_us is None for r in got) == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_samples_are_never_partitioned_by_tag_alone(frame, tmp_path, spark):
    """The shuffle of the samples is by tag and block; a busy tag is not one task."""
    frame(sample_rows(1)).write.parquet(str(tmp_path / "r"))
    rows = spark.read.parquet(str(tmp_path / "r"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = _plan(runs(rows, ["state"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    by_block = [line for line in shuffles if "_blk" in line]
    assert by_block
    # The second branch reads the same shuffle instead of scanning again.
    assert text.count("FileScan") == 1 and "ReusedExchange" in text
    # By tag alone go only the runs at block edges, filtered before the shuffle.
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(tag" in line and "_blk" not in line:
            assert any("Filter" in below for below in lines[i + 1 : i + 4])


def test_suggested_block_width(spark):
    df = spark.range(1000).selectExpr(
        "if(id % 10 = 0, 'rare', 'busy') AS tag",
        "CAST(timestamp_millis(id * 100) AS timestamp_ntz) AS ts",
    )
    # The busy tag has 900 samples in about 100 s.
    assert 9_000 < suggest_block_ms(df, target_rows=90) < 11_000

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as hyp
from hypothesis import strategies as st

from tagloom.llm import mixing

from .conftest import MESSY


@hyp(st.lists(st.text(" \t\n\x0b\x1cab é", max_size=20), max_size=6))
def test_word_counts(texts):
    expected = [len(re.findall("[^\x20\x09-\x0d]+", t)) for t in texts]
    assert mixing.word_counts(pa.array(texts, pa.large_string())).tolist() == expected


@hyp(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets_share_all_and_stop_at_thrice_the_size(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    goal = mixing.targets(sizes, weights)
    assert sum(goal) == pytest.approx(sum(sizes))
    assert all(g <= 3 * s + 1e-6 for g, s in zip(goal, sizes))
    rates = [g / w for g, s, w in zip(goal, sizes, weights) if g < 3 * s - 1e-6]
    assert not rates or max(rates) == pytest.approx(min(rates))


def test_points_are_evenly_spread():
    for n in (10, 1000, 65_537):
        x = np.sort(mixing.points(np.arange(n)).astype(float)) / 2**64
        assert np.abs(x - (np.arange(n) + 0.5) / n).max() < 4 * np.log2(n + 1) / n


def test_op6_on_given_documents(spark, given):
    rows = {r["doc_id"]: r for r in given[1]}
    got = mixing.op6_mixing(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    size, taken, goal = {}, {}, {}
    for r in got:
        given_row = rows[r["doc_id"]]
        assert r["size"] == len(re.findall("[^\x20\x09-\x0d]+", given_row["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        s = given_row["source"]
        size[s], taken[s] = size.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"]
        assert goal.setdefault(s, (r["source_size"], r["target"])) == (r["source_size"], r["target"])
    names = sorted(size)
    expected = mixing.targets([size[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    for s, e in zip(names, expected):
        assert goal[s] == (size[s], pytest.approx(e)) and taken[s] == pytest.approx(e, abs=1 + 0.01 * e)
    assert sorted(got) == sorted(mixing.op6_mixing(spark, "/root/testdata/sf0.001").collect())


def test_schedule_gives_each_slot_one_block(spark, given):
    rows = mixing.sized(given[0])
    plan = mixing.recipe(rows)
    slots = mixing.mixture(rows, plan).groupBy("slot", "at").agg({"words": "sum"}).collect()
    assert len({r["slot"] for r in slots}) == len(slots)
    assert all(r["sum(words)"] <= mixing.BLOCK for r in slots)
    early = [r["at"] for r in sorted(slots)[:200]]
    shares = np.array([g for *_, g in plan]) / sum(g for *_, g in plan)
    assert np.abs(np.bincount(early, minlength=len(plan)) / 200 - shares).max() < 0.03


def test_messy_and_empty(messy, none):
    got = mixing.mix(messy).collect()
    assert len(got) == len(MESSY) and {r["source"] for r in got} == {"a", "b", "c", None}
    assert all(r["taken"] == 0 for r in got if r["size"] == 0) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(none).count() == mixing.mixed(none).count() == 0


def test_mixture_as_documents(given):
    frame, _ = given
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(frame).collect() if r["taken"]}
    got = mixing.mixed(frame)
    assert got.columns == frame.columns
    words = {}
    for r in got.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert sum(words.values()) == pytest.approx(sum(taken.values()), rel=0.01)


@pytest.mark.parametrize("low,high", [(5, 40), (60, 130)])
def test_small_sources_beside_a_large_one_meet_their_targets(spark, low, high):
    rng = np.random.default_rng(low)
    rows = [(i, f"s{i:02}", "w " * int(n)) for i, n in enumerate(rng.integers(low, high, 50))]
    rows += [(100 + i, "large", "w " * 2000) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken, goal = {}, {}
    for r in mixing.mix(docs).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        goal[r["source"]] = int(r["target"])
    assert taken == goal
    sized = mixing.sized(docs)
    slots = mixing.mixture(sized, mixing.recipe(sized)).select("slot", "at").distinct().collect()
    assert len({r["slot"] for r in slots}) == len(slots)
    assert {r["source"] for r in mixing.mixed(docs).collect()} == {s for s, g in goal.items() if g}

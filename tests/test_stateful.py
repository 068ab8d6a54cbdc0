"""Stateful incidents and excursions give what the batch operators give, in whatever order samples arrive."""

import random
import time

import pytest
from conftest import at, sec
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.operators import intervals
from tagloom.streaming import stateful

END = 5000


@pytest.fixture
def watched(spark, hist, tmp_path):
    """The rows a watching stream gives when each list of samples arrives as a batch."""

    def run(batches, build):
        folder = tmp_path / "in"
        for batch in batches:
            hist(batch).coalesce(1).write.mode("append").parquet(str(folder))
            time.sleep(0.05)
        stream = spark.readStream.schema(schemas.HISTORY).option("maxFilesPerTrigger", 1).parquet(str(folder))
        found = build(stream)
        writer = found.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
        writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(found.schema).parquet(str(tmp_path / "out"))

    return run


def shuffled(seed, late=290, n=200):
    """Samples of two tags, in batches, each up to ``late`` seconds behind; then one that moves the watermark on."""
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), t, rng.choice([1, 1, 5, 9, 9, None]), rng.choice([192, 192, 192, 0])) for t in rng.sample(range(2000), n)]
    arriving = sorted(rows, key=lambda r: r[1] + rng.randrange(late))
    # Both tags end on a sample in no state, so that nothing is open behind the watermark.
    ends = [(tag, 2400, 5) for tag in "ab"]
    batches = [arriving[k : k + 40] for k in range(0, n, 40)] + [ends, [("b", END, 5)], [("b", END + 10, 5)]]
    return rows + ends, batches


def shown(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed, slot", [(1, 60), (2, 7)])
def test_incidents_out_of_order(hist, watched, seed, slot):
    rows, batches = shuffled(seed)
    rules = [("a", ">", 5), ("b", "<", 5), ("b", ">", 8)]
    got = watched(batches, lambda s: stateful.watch_incidents(s, rules, slot_s=slot))
    batch = intervals.incidents(hist(rows), rules, None, at(END)).filter("end_ts IS NOT NULL")
    assert batch.count() > 20
    assert shown(got.select(*batch.columns)) == shown(batch)


def test_excursions_out_of_order(hist, watched):
    rows, batches = shuffled(4)
    got = watched(batches, lambda s: stateful.watch_excursions(s, ["a", "b"], 2, 8, slot_s=600))
    batch = intervals.threshold_extrema(hist(rows), ["a", "b"], 2, 8, at(-1), at(END))
    assert batch.count() > 20
    assert shown(got) == shown(batch)


def test_too_late_samples_are_left_out(watched):
    batches = [[("a", 0, 9), ("a", 100, 1)], [("a", 1000, 1)], [("a", 1001, 1)], [("a", 50, 1)], [("a", 2000, 1)], [("a", 2001, 1)]]
    got = watched(batches, lambda s: stateful.watch_incidents(s, [("a", ">", 5)]))
    assert [(sec(r.start_ts), sec(r.end_ts), r.duration_ms) for r in got.collect()] == [(0, 100, 100_000)]


@pytest.mark.parametrize("together", [False, True])
def test_silence_ends_incidents(watched, together):
    """A gap in the samples and a tag that is never written again end alike, by timer or by the next sample."""
    first = [("a", 0, 9), ("a", 10, 9), ("gone", 0, 9), ("b", 0, 1)]
    later = [("a", 2000, 9), ("a", 2030, 1), ("b", 2000, 1)]
    ends = [[("b", 4000, 1)], [("b", 4001, 1)], [("b", 8000, 1)], [("b", 8001, 1)]]
    batches = [first + later, *ends] if together else [first, [("b", 1500, 1)], [("b", 1501, 1)], later, *ends]
    rules = [("a", ">", 5), ("gone", ">", 5), ("b", ">", 5)]
    got = watched(batches, lambda s: stateful.watch_incidents(s, rules, silence_s=600))
    seen = sorted((r.tag, sec(r.start_ts), sec(r.end_ts)) for r in got.collect())
    assert seen == [("a", 0, None), ("a", 2000, 2030), ("gone", 0, None)]


def test_empty(watched):
    assert watched([[]], lambda s: stateful.watch_excursions(s, ["a"], 2, 8)).count() == 0


def test_each_slot_is_sorted_once(hist):
    slots = stateful._slots(hist([("a", 0, 1)]), ["tag"], F.col("value"), F.lit("on"), "1 minute", 60)
    plan = stateful._pieces(slots, ["tag"], 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1
    assert plan.count("filter(transform(") == plan.count("array_min(") == 1


def test_a_busy_slot_reaches_a_key_in_few_stretches(hist):
    """Of a slot the tag's own key gets three stretches at most; those between come in groups of bounded size."""
    n = 1000
    slots = stateful._slots(hist([("a", t, t % 3) for t in range(n)]), ["tag"], F.col("value"), F.col("value").cast("string"), "1 minute", 3600)
    rows = stateful._pieces(slots, ["tag"], None).collect()
    assert max(len(r.us) for r in rows) <= 256
    own = [r for r in rows if r["_group"] is None]
    assert [len(r.us) for r in own] == [3]
    assert sum(len(r.us) for r in rows if r["_group"] is not None) == n - 2

"""The streaming jobs over several batches give what the batch operators give."""

import random
import time

import pytest
from conftest import at, sec

from tagloom import schemas
from tagloom.operators import intervals, replication, retrieval, usage
from tagloom.sources import export, state
from tagloom.streaming import jobs


@pytest.fixture
def feed(spark, tmp_path):
    """A stream that delivers each given DataFrame as a batch of its own."""

    def make(frames, schema):
        folder = tmp_path / "in"
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(str(folder))
            time.sleep(0.05)
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))

    return make


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def samples(seed=1, n=80):
    rng = random.Random(seed)
    return sorted(
        ((rng.choice("aab"), t, rng.choice([1, 1, 9, 9, None])) for t in rng.sample(range(400), n)),
        key=lambda r: r[1],
    )


@pytest.mark.parametrize("width", [5000, 3_600_000])
def test_incidents(spark, hist, feed, tmp_path, width):
    rows = samples()
    stream = feed([hist(rows[i : i + 20]) for i in range(0, 80, 20)], schemas.HISTORY)
    rules = [("a", ">", 5), ("b", "<", 5), ("b", ">", 8)]

    def follow(checkpoint):
        run(jobs.follow_incidents(stream, rules, str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / checkpoint), block_ms=width))
        return sorted(map(str, spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()))

    batch = intervals.incidents(hist(rows), rules, None, at(1000)).filter("end_ts IS NOT NULL")
    expected = sorted(map(str, batch.collect()))
    assert follow("c1") == expected
    # Running the same batches again leaves the same output.
    assert follow("c2") == expected
    open_now = state.read_version(spark, str(tmp_path / "state"), jobs.INCIDENT_STATE).filter("on")
    still = intervals.incidents(hist(rows), rules, None, at(1000)).filter("end_ts IS NULL")
    assert open_now.count() == still.count()


def test_export(spark, hist, feed, tmp_path):
    rows = samples(2)
    stream = feed([hist(rows[i : i + 16]) for i in range(0, 80, 16)], schemas.HISTORY)
    run(jobs.export_changes(stream, str(tmp_path / "s"), str(tmp_path / "o"), str(tmp_path / "c")))
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "o/export-*/data")).collect())
    lines = export.fastload_lines(retrieval.delta(hist(rows))).filter("line IS NOT NULL")
    assert got == sorted(r.line for r in lines.collect())


def session_frame(spark, ids, last):
    rows = [("n", f"u{i}", "app", "m", f"ip{i % 2}", "plant", "h", f"c{i}", i, at(0), at(last), last, 0, 0) for i in ids]
    return spark.createDataFrame(rows, schemas.SESSIONS)


def test_usage_refresh_and_metrics(spark, feed, tmp_path):
    stream = feed([session_frame(spark, [1, 2], 30), session_frame(spark, [2, 3], 150)], schemas.SESSIONS)
    run(jobs.refresh_usage(stream, str(tmp_path / "a"), str(tmp_path / "h"), str(tmp_path / "c")))
    active = state.read_commit(spark, str(tmp_path / "a"), schemas.USAGE_ACTIVE)
    assert {r.conn_id: sec(r.last_ts) for r in active.collect()} == {"c1": 30, "c2": 150, "c3": 150}
    metrics = spark.read.parquet(str(tmp_path / "h"))
    got = {(r.tag, sec(r.ts)): r.value for r in metrics.collect()}
    assert got[("UsageActiveUsers", 0)] == 2 and got[("UsageConnectedUsers", 0)] == 2
    assert got[("UsageActiveUsers", 120)] == 2 and got[("UsageConnectedUsers", 120)] == 3
    assert got[("UsageConnectedNodes", 120)] == 2


def test_usage_rollup(spark, table, feed, tmp_path):
    tracked = table([("n", f"u{i}", f"c{i}", i, "m", "ip", at(9), at(0), "app", 5, 0, 0) for i in (1, 2, 3)], schemas.USAGE_ACTIVE)
    jobs.seed_tracked(tracked, str(tmp_path / "a"))
    stream = feed([session_frame(spark, [1, 2], 30), session_frame(spark, [1], 60)], schemas.SESSIONS)
    run(jobs.roll_up_usage(stream, str(tmp_path / "a"), str(tmp_path / "s"), str(tmp_path / "c")))
    left = state.read_commit(spark, str(tmp_path / "a"), schemas.USAGE_ACTIVE)
    assert [r.conn_id for r in left.collect()] == ["c1"]
    summary = state.read_commit(spark, str(tmp_path / "s"), schemas.USAGE_SUMMARY)
    users = {r.name: (r.active_days, r.usage) for r in summary.filter("usage_type = 'User'").collect()}
    assert users == {"u2": (1, 5), "u3": (1, 5)}


def test_refresh_and_rollup_take_turns(spark, tmp_path):
    active, summary = str(tmp_path / "a"), str(tmp_path / "s")

    def snapshot(ids, last):
        session_frame(spark, ids, last).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schemas.SESSIONS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        for n in ("", "again"):  # with a new checkpoint the batches come once more and change nothing
            run(jobs.refresh_usage(stream, active, str(tmp_path / "h"), str(tmp_path / f"refresh{n}")))
            run(jobs.roll_up_usage(stream, active, summary, str(tmp_path / f"rollup{n}")))

    def tracked():
        return {r.conn_id: sec(r.last_ts) for r in state.read_commit(spark, active, schemas.USAGE_ACTIVE).collect()}

    def users():
        rows = state.read_commit(spark, summary, schemas.USAGE_SUMMARY).filter("usage_type = 'User'").collect()
        return {r.name: r.usage for r in rows}

    snapshot([1, 2], 30)
    assert tracked() == {"c1": 30, "c2": 30} and users() == {}
    snapshot([2, 3], 150)
    assert tracked() == {"c2": 150, "c3": 150} and users() == {"u1": 30}
    snapshot([3, 4], 270)
    assert tracked() == {"c3": 270, "c4": 270} and users() == {"u1": 30, "u2": 150}
    assert [(c.job, c.batch) for c in state.commits(spark, active)] == [(j, b) for b in range(3) for j in ("refresh", "rollup")]


def test_pruned_commits_leave_each_job_its_newest(spark, table, tmp_path):
    for job, batch in [("slow", 0), *(("fast", b) for b in range(6))]:
        state.write_commit(table([(batch,)], "n int"), str(tmp_path / "t"), job, batch)
    state.prune_commits(spark, str(tmp_path / "t"), keep=2)
    assert [(c.number, c.job, c.batch) for c in state.commits(spark, str(tmp_path / "t"))] == [(0, "slow", 0), (5, "fast", 4), (6, "fast", 5)]
    assert state.read_commit(spark, str(tmp_path / "t"), "n int").first().n == 5


def test_windowed_usage(spark, feed, tmp_path):
    frames = [session_frame(spark, [1, 2], 30), session_frame(spark, [3], 70), session_frame(spark, [4], 4000)]
    stream = feed(frames, schemas.SESSIONS)
    query = (
        jobs.windowed_usage(stream).writeStream.outputMode("append").format("memory").queryName("seen")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {sec(r.ts): (r.active_users, r.active_nodes) for r in spark.table("seen").collect()}
    assert got[0] == (2, 2) and got[60] == (1, 1)


def test_windowed_usage_is_exact_out_of_order(spark, feed, tmp_path):
    """Rows repeat over batches and come late within the watermark; those beyond it and open windows are left out."""
    rng = random.Random(4)
    names = [None, *(f"u{k}" for k in range(6))]
    rows = [(rng.choice(names), f"ip{rng.randrange(4)}", t) for t in rng.choices(range(0, 1800), k=300)]
    rows.sort(key=lambda r: r[2] + rng.randrange(0, 290))
    kind = "user_name string, ip string, last_ts timestamp_ntz"
    parts = [rows[k : k + 60] for k in range(0, 300, 60)] + [[(None, None, 2000)], [("late", "late", 30)], [(None, None, 2400)]]
    stream = feed([spark.createDataFrame([(u, p, at(s)) for u, p, s in part], kind) for part in parts], kind)
    query = (
        jobs.windowed_usage(stream, rate_s=120).writeStream.outputMode("append").format("memory").queryName("exactly")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {sec(r.ts): (r.active_users, r.active_nodes) for r in spark.table("exactly").collect()}
    expected = {}
    for w in sorted({s // 120 * 120 for _, _, s in rows} | {1920}):
        if w + 120 <= 2400 - 300:
            mine = [r for r in rows if r[2] // 120 * 120 == w]
            expected[w] = (len({u for u, _, _ in mine} - {None}), len({p for _, p, _ in mine}))
    assert got == expected and expected[1920] == (0, 0)


def test_new_tags(spark, table, feed, tmp_path):
    schema = "tag string, tag_type int, acquisition_type int, raw_type int, created_by string"
    frames = [table([("x", 1, 0, 3, "me")], schema), table([("y", 2, 0, None, "me"), ("z", 5, 0, None, "me")], schema)]
    groups = table([(1, "Simple", 1, 1, None), (3, "States", 3, 1, 1)], schemas.REPLICATION_GROUP)
    servers = table([(1, "tier2")], schemas.REPLICATION_SERVER)
    entities = table([(1, "x", 1, 1)], schemas.REPLICATION_ENTITY)
    none = table([], "tag string")
    stream = feed(frames, schema)
    run(jobs.replicate_new_tags(stream, groups, entities, servers, none, str(tmp_path / "o"), str(tmp_path / "c")))
    got = {(r.source_tag, r.group) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    whole = replication.missing_replication(frames[0].union(frames[1]), groups, entities, servers, none)
    assert got == {("x", "States"), ("y", "Simple"), ("y", "States")} == {(r.source_tag, r.group) for r in whole.collect()}


def test_sessions_gone_in_the_newest_snapshot_are_gone(spark):
    first = session_frame(spark, [1, 2], 10).selectExpr("*", "1 AS snapshot_ts")
    second = session_frame(spark, [1], 20).selectExpr("*", "2 AS snapshot_ts")
    got = jobs.latest_sessions(first.union(second))
    assert [r.conn_id for r in got.collect()] == ["c1"] and "snapshot_ts" not in got.columns


def test_latest_snapshot_wins(spark):
    both = session_frame(spark, [1], 10).union(session_frame(spark, [1], 20))
    assert [sec(r.last_ts) for r in jobs.latest_sessions(both).collect()] == [20]
    assert usage.client_load(jobs.latest_sessions(both), ["application"]).first().processes == 1

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.operators import replication as rep


def t(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def groups(table):
    return table([(1, "Simple", 1, 1, None), (2, "Hourly", 2, 1, 10), (3, "Minutes", 3, 1, 11), (4, "Local", 1, 2, None), (5, "Lost", 1, 9, None)], schemas.REPLICATION_GROUP)


@pytest.fixture
def servers(table):
    return table([(1, "tier2"), (2, "Local Replication")], schemas.REPLICATION_SERVER)


@pytest.fixture
def entities(table):
    return table([(100, "a", 1, 1), (101, "a", 2, 1), (102, "b", 3, 1), (103, "a.PV", 1, 1)], schemas.REPLICATION_ENTITY)


def test_config_and_counts(entities, groups, servers):
    got = [tuple(r) for r in rep.replication_config(entities, groups, servers).collect()]
    assert got == [("tier2", "Hourly", "Analog Summary", 1), ("tier2", "Minutes", "State Summary", 1), ("tier2", "Simple", "Simple", 2)]
    assert tuple(rep.entities_per_tag(entities).first()) == ("a", 2)


def test_resolve_groups(groups):
    counts = {s: rep.resolve_groups(groups, s).count() for s in ("*", "(Simple)", "(None)", "Hourly", "x")}
    assert counts == {"*": 5, "(Simple)": 3, "(None)": 0, "Hourly": 1, "x": 0}


def test_missing_replication_matrix(table, groups, servers, entities):
    tags = [
        ("float", 1, 0, 2, "me"), ("int", 1, 0, 3, "me"), ("disc", 2, 0, None, "me"), ("str", 3, 0, None, "me"),
        ("event", 5, 0, None, "me"), ("sum", 7, 0, None, "me"), ("sys", 1, 3, 3, "me"), ("rep", 1, 0, 3, "ReplicationService"),
        ("who", 1, 0, 3, None), ("out", 1, 0, 3, "me"), ("a", 1, 0, 3, "me"), ("odd", 4, 0, None, "me"),
    ]
    tag = table(tags, "tag string, tag_type int, acquisition_type int, raw_type int, created_by string")
    excluded = table([("out",), (None,)], "tag string")
    got = {(r.source_tag, r.group) for r in rep.missing_replication(tag, groups, entities, servers, excluded).collect()}
    assert got == {
        ("float", "Simple"), ("float", "Hourly"),
        ("int", "Simple"), ("int", "Hourly"), ("int", "Minutes"),
        ("disc", "Simple"), ("disc", "Minutes"), ("str", "Simple"), ("str", "Minutes"),
        ("a", "Minutes"), ("odd", "Simple"),
    }


def queue_rows():
    return [
        (1, "a", 1, 0, t("2024-01-01 00:59:59"), t("2024-01-01 02:00:00"), t("2024-01-01"), 0),
        (2, "a", 1, 0, t("2024-01-03 00:00:00"), t("2024-01-03 00:01:00"), t("2024-01-02"), 0),
        (3, "b", 2, 1, t("2024-01-09 00:00:00"), t("2024-01-09 06:00:00"), t("2024-01-03"), 0),
    ]


@pytest.fixture
def queue(table):
    return table(queue_rows(), schemas.SYNC_QUEUE)


def test_queue_summary(queue, servers):
    a, b = rep.queue_summary(queue, servers).collect()
    # 61 and 1 minutes: whole-number average; hours count boundaries.
    assert (a.source_tag, a.span_hours, a.avg_mins, a.entries, a.server) == ("a", 48, 31, 2, "tier2")
    assert (b.source_tag, b.span_hours, b.avg_mins) == ("b", 6, 360)


def test_queue_guards(queue):
    got = {r.server_key: (r.queue_size, r.old_entries, r.queue_days, r.refusal, r.may_start) for r in rep.queue_guards(queue, "2024-01-10").collect()}
    assert got == {1: (2, 2, 2, "old entries", False), 2: (1, 0, None, None, True)}
    idle = rep.queue_guards(queue, "2024-01-10", servers=queue.sparkSession.range(1, 4).withColumnRenamed("id", "server_key"))
    assert {r.server_key: (r.queue_size, r.period_entries, r.may_start) for r in idle.collect()} == {1: (2, 0, False), 2: (1, 0, True), 3: (0, 0, True)}
    r = rep.queue_guards(queue, "2024-01-10", server=7).first()
    assert (r.queue_size, r.may_start) == (0, True)
    r = rep.queue_guards(queue, "2024-01-10", server=2, period=("2024-01-09", "2024-01-10"), pattern="b%").first()
    assert (r.period_entries, r.refusal) == (1, "period already queued")


def test_backfill_windows(table):
    rows = [
        ("2024-01-05 00:00", "2024-01-06 00:00"), ("2024-01-04 00:00", "2024-01-05 00:00"),
        ("2024-01-04 00:00:30", "2024-01-04 01:00"), ("2024-01-03 00:00", "2024-01-04 00:00"),
        ("2024-01-02 00:00", "2024-01-03 00:00"), ("2024-01-07 00:00", "2024-01-08 00:00"),
    ]
    blocks = table([(t(a), t(b), 60) for a, b in rows], schemas.HISTORY_BLOCK)
    got = rep.backfill_windows(blocks, "2024-01-02 12:00", "2024-01-05 09:00", "2024-01-05 10:00").collect()
    assert [(r.start_local, r.end_local, r.is_first) for r in got] == [
        # Ends no later than now; the block partly before the range is skipped.
        (t("2024-01-05 00:00"), t("2024-01-05 10:00"), True),
        (t("2024-01-04 00:00"), t("2024-01-05 00:00"), False),
        (t("2024-01-03 00:00"), t("2024-01-04 00:00"), False),
    ]
    assert got[0].start_utc == t("2024-01-04 23:00") and got[0].end_utc == t("2024-01-05 09:00")
    (only,) = rep.backfill_windows(blocks, "2024-01-02 12:00", "2024-01-02 18:00", "2024-01-09").collect()
    assert (only.start_local, only.start_utc) == (t("2024-01-02 12:00"), t("2024-01-02 11:00"))
    assert rep.backfill_windows(blocks, "2023-01-01", "2023-02-01", "2024-01-09").count() == 0


def test_default_period(spark):
    day = 1440
    df = spark.createDataFrame([(m,) for m in (7 * day, 7 * day + 1, 31 * day + 1, 90 * day, 90 * day + 1)], "m int")
    assert [r[0] for r in df.select(rep.default_period(F.col("m"))).collect()] == [0, 1, 5, 5, 60]


def test_backfill_requests(table, entities, groups):
    schedules = table([(10, 1, "Hour"), (11, 5, "Minute")], schemas.REPLICATION_SCHEDULE)
    windows = table([(t("2024-01-01"), t("2024-01-02")), (t("2024-01-02"), t("2024-01-03"))], "start_utc timestamp_ntz, end_utc timestamp_ntz")
    queued = table([(102, t("2024-01-01 00:00:00.001"), t("2024-01-02"))], "entity_key bigint, mod_start_utc timestamp_ntz, mod_end_utc timestamp_ntz")

    def requests(**kw):
        df = rep.backfill_requests(entities, groups, schedules, queued, windows, now_utc="2024-01-05", **kw)
        return sorted((r.entity_key, r.mod_start_utc.day) for r in df.collect())

    assert requests(server=1) == [(100, 1), (100, 2), (101, 1), (101, 2), (102, 2), (103, 1), (103, 2)]
    assert requests(server=1, min_period=5) == [(101, 1), (101, 2), (102, 2)]
    assert requests(server=1, min_period=60) == [(101, 1), (101, 2)]
    assert requests(server=1, pattern="%.PV") == [(103, 1), (103, 2)]
    assert requests(server=9) == []


def test_eta_guards_against_zero(table):
    log = table([(t("2024-01-10"), t("2024-02-01 00:10")), (t("2024-01-09"), t("2024-02-01 00:10")), (t("2024-01-05"), t("2024-02-01 00:00"))], "end_local timestamp_ntz, at_ts timestamp_ntz")
    got = rep.backfill_eta(log, "2024-01-01", "2024-01-10", "2024-02-01").collect()
    assert [r.minutes_remaining for r in got] == [None, 80.0, None]
    assert got[1].eta_ts == t("2024-02-01 01:30")


def test_status_log(table, spark, tmp_path):
    steps = table([(t("2024-02-01 00:10"), 1)], "at_ts timestamp_ntz, user_key int")
    name = rep.invocation_id(F.lit("tier2"), F.col("at_ts"), 0)
    parts = dict(id=name, count=F.lit(3), start=F.lit("x"), end=F.lit("y"))
    for kind in rep.MESSAGES:
        rep.log_status(rep.status_rows(steps, kind, F.lit(1), **parts), str(tmp_path / "a"))
    notes = spark.read.parquet(str(tmp_path / "a"))
    users = table([(2, "x")], schemas.USER)
    got = {r.content: (r.user_name, r.tag) for r in rep.status_log(notes, users, "2024-02-10").collect()}
    assert got == {
        "2024-02-01 00:10:00 for 'tier2' (all) Beginning backfill for 3 tags from 'x' to 'y'": (None, "SysReplicationSyncQueueItems1"),
        "2024-02-01 00:10:00 for 'tier2' (all) Added 3 items from x to y": (None, "SysReplicationSyncQueueItems1"),
    }
    assert rep.status_log(notes, users, "2024-05-10").count() == 0
    servers = table([(1, "tier2"), (2, "far")], schemas.REPLICATION_SERVER)
    assert rep.server_log(notes, servers, 1).count() == 4
    assert rep.server_log(notes, servers, 1, n=2).count() == 2
    assert rep.server_log(notes, servers, 5).count() == 0


def test_queue_upkeep(queue):
    assert [r.entity_key for r in rep.queue_by_execution(queue).collect()] == [3, 2, 1]
    due = {r.entity_key: r.earliest_exec_utc for r in rep.queue_due_now(queue, "2024-01-03 00:06:00").collect()}
    assert due[1] == t("2024-01-03 00:06:00") and due[2] == t("2024-01-02")
    reset = {r.entity_key: (r.request_version, r.earliest_exec_utc) for r in rep.queue_due_now(queue, "2024-02-01", server=2).collect()}
    assert reset[3] == (0, t("2024-02-01")) and reset[1][1] == t("2024-01-01")
    assert {r.entity_key for r in rep.queue_purge(queue, "2024-01-03 00:01:00").collect()} == {2, 3}


def test_backfill_plan_counts_what_it_adds(table, entities, groups):
    schedules = table([(10, 1, "Hour"), (11, 5, "Minute")], schemas.REPLICATION_SCHEDULE)
    windows = table(
        [(t("2024-01-02"), t("2024-01-03"), t("2024-01-02"), t("2024-01-03")), (t("2024-01-01"), t("2024-01-02"), t("2024-01-01"), t("2024-01-02"))],
        "start_local timestamp_ntz, end_local timestamp_ntz, start_utc timestamp_ntz, end_utc timestamp_ntz",
    )
    kind = "entity_key bigint, mod_start_utc timestamp_ntz, mod_end_utc timestamp_ntz"
    queued = table([(e, t("2024-01-01 00:00:00.001"), t("2024-01-02")) for e in (100, 101, 102, 103)], kind)
    steps = table([(t("2024-01-02"), t("2024-02-01 01:00")), (t("2024-01-01"), t("2024-02-01 02:00"))], "start_local timestamp_ntz, at_ts timestamp_ntz")
    servers = table([(1, "tier2"), (2, "far")], schemas.REPLICATION_SERVER)

    def planned(oldest, **kw):
        requests, rows = rep.backfill_plan(
            entities, groups, schedules, queued, windows, servers, 1, oldest, "2024-01-03", "2024-02-01", steps, "2024-02-01", 7, **kw
        )
        told = [r.content.removeprefix("2024-02-01 00:00:00 for 'tier2' ") for r in rows.orderBy("date_created", "content").collect()]
        return requests.count(), told

    begin = " Beginning backfill for 4 tags from '{} 00:00:00' to '2024-01-03 00:00:00'"
    added = " Added {} items from {} 00:00:00 to {} 00:00:00"
    # All of the first window are queued already, and it is recorded as none.
    assert planned("2024-01-01") == (
        4,
        ["(all)" + begin.format("2024-01-01"), "(all)" + added.format(4, "2024-01-02", "2024-01-03"), "(all)" + added.format(0, "2024-01-01", "2024-01-02"), "(all) completed"],
    )
    # More than seven days take summaries of a minute, more than ninety those of an hour.
    assert planned("2023-12-20")[1][0] == "(1+ min)" + begin.format("2023-12-20")
    assert planned("2023-01-01")[0] == 1 and planned("2023-01-01")[1][1].startswith("(60+ min) Added 1 items")
    assert planned("2023-01-01", min_period=0)[0] == 4
    assert planned("2024-01-01", max_queue=7)[1][-1] == "(all) backfill timed out"

import pytest
from conftest import at, sec

from tagloom import schemas
from tagloom.operators import usage


def session(user, conn, pid=1, db="plant", host="h", app="trend", first=0, last=10, cpu=1, node="n1", ip="i1"):
    return (node, user, app, "m1", ip, db, host, conn, pid, at(first), at(last), cpu, 10, 100)


def tracked_row(user, conn, pid=1, first=0, last=5, app="trend", cpu=7, node="n1", ip="i1"):
    return (node, user, conn, pid, "m1", ip, at(last), at(first), app, cpu, 0, 0)


@pytest.fixture
def current(table):
    return table(
        [session("u1", "c1", last=20), session("u2", "c2", pid=9), session("u4", "c4"), session("u5", "c5", db=None, host=None), session("u6", "c6", app="other"), session("u7", "c7", host="")],
        schemas.SESSIONS,
    )


@pytest.fixture
def tracked(table):
    return table([tracked_row("u1", "c1"), tracked_row("u2", "c2"), tracked_row("u3", "c3", last=3), tracked_row("u6", "c6", app="other")], schemas.USAGE_ACTIVE)


def test_client_load(current):
    (r,) = usage.client_load(current, ["application"], "plant").filter("application = 'trend'").collect()
    # u1, u2, u4 and, having neither database nor client, u5.
    assert (r.processes, r.cpu, r.io, r.mem, r.minutes) == (4, 4, 40, 400, 0)
    by_db = usage.client_load(current, ["database"]).collect()
    assert [(r.database, r.processes) for r in by_db] == [(None, 1), ("plant", 5)]
    assert usage.client_load(current, ["node", "user_name", "application", "mac", "ip"]).count() == 6


def test_minutes_are_boundaries(table):
    df = table([session("u", "c", first=59, last=60)], schemas.SESSIONS)
    assert usage.client_load(df, ["application"]).first().minutes == 1


def test_reconcile(current, tracked):
    got = usage.reconcile(current, tracked, "plant", ["tr"]).collect()
    assert sorted((r.status, r.conn_id or r.active_conn_id) for r in got) == [
        ("closed", "c3"),
        ("new", "c4"),
        ("new", "c5"),
        ("open", "c1"),
        ("open", "c2"),
    ]
    assert usage.closed_ids(usage.reconcile(current, tracked)).first().conn_id == "c3"


def test_refresh_needs_the_same_process(current, tracked):
    got = {r.conn_id: (r.pid, r.cpu, sec(r.last_ts)) for r in usage.refresh_active(tracked, current).collect()}
    assert got["c1"] == (1, 1, 20)
    assert got["c2"] == (1, 7, 5)
    assert got["c3"] == (1, 7, 3)
    assert set(got) == {f"c{i}" for i in range(1, 8)}


def test_metrics(tracked):
    got = {r.tag: r.value for r in usage.usage_metrics(tracked, at(64), 60).collect()}
    assert got == {"UsageActiveUsers": 3, "UsageActiveNodes": 1, "UsageConnectedUsers": 4, "UsageConnectedNodes": 1}
    assert {sec(r.ts) for r in usage.usage_metrics(tracked, at(64), 60).collect()} == {60}


def test_rollup_purge_and_merge(tracked, table):
    closed = table([("c1",), ("c3",)], "conn_id string")
    rolled = usage.usage_rollup(tracked, closed)
    got = {(r.usage_type, r.name): (sec(r.first_ts), sec(r.last_ts), r.usage) for r in rolled.collect()}
    assert got[("Node", "n1")] == (0, 5, 14)
    assert got[("User", "u3")] == (0, 3, 7)
    assert {k[0] for k in got} == {"Node", "User", "Application", "Address", "MACAddress"}
    assert {r.conn_id for r in usage.purge_closed(tracked, closed).collect()} == {"c2", "c6"}


def test_merge_usage_active_days(table):
    day = 86_400
    summary = table(
        [("User", "same", at(0), at(100), 3, 5), ("User", "far", at(0), at(100), 3, 5), ("User", "near", at(0), at(100), 3, 5), ("User", "idle", at(0), at(9), 1, 1)],
        schemas.USAGE_SUMMARY,
    )
    rollup = table(
        [("User", "same", at(50), at(5 * day), 10), ("User", "far", at(day), at(2 * day), 11), ("User", "near", at(200), at(day), 12), ("User", "new", at(1), at(2), 13), ("User", None, at(1), at(2), 14), ("Node", "far", at(1), at(2), 15)],
        "usage_type string, name string, first_ts timestamp_ntz, last_ts timestamp_ntz, usage bigint",
    )
    got = {(r.usage_type, r.name): (r.active_days, r.usage, sec(r.first_ts), sec(r.last_ts)) for r in usage.merge_usage(summary, rollup).collect()}
    assert got == {
        ("User", "same"): (3, 10, 0, 5 * day),
        ("User", "far"): (4, 11, 0, 2 * day),
        ("User", "near"): (3, 12, 0, day),
        ("User", "idle"): (1, 1, 0, 9),
        ("User", "new"): (1, 13, 1, 2),
        ("Node", "far"): (1, 15, 1, 2),
    }


def test_open_sessions(table):
    processes = table([(1, "a"), (2, "b")], "session_id int, program string")
    connections = table([(1, "c1", "i", None), (1, "c2", "i", "c1"), (3, "c3", "i", None)], "session_id int, conn_id string, ip string, parent_conn_id string")
    assert [r.conn_id for r in usage.open_sessions(processes, connections).collect()] == ["c1"]

"""Session load and usage tracking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.time import boundary_diff, floor_time, ts_lit
from tagloom.schemas import GOOD

# Usage dimensions: label, column (fixed values).
DIMENSIONS = (
    ("Node", "node"),
    ("User", "user_name"),
    ("Application", "application"),
    ("Address", "ip"),
    ("MACAddress", "mac"),
)
SESSION_KEY = ("user_name", "node", "conn_id", "application")
METRIC_TAGS = {
    "active_users": "UsageActiveUsers",
    "active_nodes": "UsageActiveNodes",
    "connected_users": "UsageConnectedUsers",
    "connected_nodes": "UsageConnectedNodes",
}


def open_sessions(processes: DataFrame, connections: DataFrame) -> DataFrame:
    """Server processes with the address and id of their top-level connection."""
    top = connections.filter(F.col("parent_conn_id").isNull()).select(
        "session_id", "conn_id", "ip"
    )
    return processes.join(top, "session_id")


def for_database(sessions: DataFrame, database: str) -> DataFrame:
    """Sessions of a database that name a client process, and those with neither."""
    return sessions.filter(
        ((F.col("database") == database) & (F.col("host_process") != ""))
        | (F.col("database").isNull() & F.col("host_process").isNull())
    )


def client_load(
    sessions: DataFrame, by: Sequence[str], database: str | None = None
) -> DataFrame:
    """Processes, job times and resource use per group of sessions, optionally
    of one database."""
    rows = sessions if database is None else for_database(sessions, database)
    order = [c for c in by if c in ("database",)] or (
        [F.desc("cpu")] if len(by) == 1 else ["application", F.desc("cpu")]
    )
    return (
        rows.groupBy(*by)
        .agg(
            F.count("*").alias("processes"),
            F.min("first_ts").alias("first_job"),
            F.max("last_ts").alias("last_job"),
            F.sum("cpu").alias("cpu"),
            F.sum("io").alias("io"),
            F.sum("mem").alias("mem"),
        )
        .withColumn("minutes", boundary_diff("minute", F.col("first_job"), F.col("last_job")))
        .orderBy(*order, *by)
    )


def reconcile(
    current: DataFrame,
    tracked: DataFrame,
    database: str | None = None,
    application_prefixes: Sequence[str] = (),
) -> DataFrame:
    """Current sessions matched with the tracked ones.

    ``status`` is ``open`` for a match, ``new`` for an untracked session and
    ``closed`` for a tracked one no longer there, which keeps only
    ``active_conn_id``. The filters apply to the matched rows, so a tracked
    session whose current one fails them is neither open nor closed.
    """
    known = tracked.select(
        *[F.col(c).alias(f"_{c}") for c in SESSION_KEY], F.col("conn_id").alias("active_conn_id")
    )
    matched = current.join(
        known, [current[c] == known[f"_{c}"] for c in SESSION_KEY], "full"
    )
    if database is not None or application_prefixes:
        wanted = F.col("host_process") != ""
        if database is not None:
            wanted = wanted & (F.col("database") == database)
        if application_prefixes:
            named = [F.col("application").startswith(p) for p in application_prefixes]
            wanted = wanted & reduce(lambda a, b: a | b, named)
        # A closed session has neither; a current one with neither is kept too.
        neither = F.col("database").isNull() & F.col("host_process").isNull()
        matched = matched.filter(wanted | neither)
    status = (
        F.when(F.col("conn_id").isNull(), "closed")
        .when(F.col("active_conn_id").isNull(), "new")
        .otherwise("open")
    )
    return matched.select(
        "node",
        "active_conn_id",
        "conn_id",
        "pid",
        "user_name",
        "application",
        "mac",
        "ip",
        "first_ts",
        "last_ts",
        "cpu",
        "io",
        "mem",
        status.alias("status"),
    )


def refresh_active(tracked: DataFrame, current: DataFrame) -> DataFrame:
    """Tracked sessions after a snapshot: last time and usage of those still
    there with the same process, and the new ones. Closed ones stay until purged."""
    key = list(SESSION_KEY)
    new = current.select(*key, *[F.col(c).alias(f"_{c}") for c in _MUTABLE + _FIXED])
    known = tracked.withColumn("_known", F.lit(True))
    both = known.join(new, key, "full")
    same_process = F.col("pid") == F.col("_pid")

    def merged(name: str, on_match: Column) -> Column:
        return (
            F.when(F.col("_known").isNull(), F.col(f"_{name}"))
            .when(on_match, F.col(f"_{name}"))
            .otherwise(F.col(name))
            .alias(name)
        )

    values = {c: merged(c, F.coalesce(same_process, F.lit(False))) for c in _MUTABLE}
    values |= {c: merged(c, F.lit(False)) for c in _FIXED}
    return both.select(*[values.get(c, F.col(c)) for c in tracked.columns])


_MUTABLE = ["last_ts", "cpu", "mem", "io"]
_FIXED = ["pid", "mac", "ip", "first_ts"]


def usage_metrics(tracked: DataFrame, now, rate_s: int = 60) -> DataFrame:
    """Users and addresses that are active (seen less than ``rate_s`` seconds
    ago) and connected, as four good samples at the floored time."""
    active = boundary_diff("second", F.col("last_ts"), ts_lit(now)) < rate_s
    # Sessions are combined first: the distinct counts handle each row several times.
    seen = tracked.groupBy("user_name", "ip").agg(F.max(active).alias("active"))
    counts = seen.agg(
        F.countDistinct(F.when(F.col("active"), F.col("user_name"))).alias("active_users"),
        F.countDistinct(F.when(F.col("active"), F.col("ip"))).alias("active_nodes"),
        F.countDistinct("user_name").alias("connected_users"),
        F.countDistinct("ip").alias("connected_nodes"),
    )
    pairs = ", ".join(f"'{tag}', {column}" for column, tag in METRIC_TAGS.items())
    return counts.select(
        F.expr(f"stack({len(METRIC_TAGS)}, {pairs}) AS (tag, n)")
    ).select(
        "tag",
        floor_time(ts_lit(now), rate_s).alias("ts"),
        F.col("n").cast("double").alias("value"),
        F.lit(GOOD).alias("quality"),
    )


def closed_ids(reconciled: DataFrame) -> DataFrame:
    """Connection ids of tracked sessions no longer there."""
    return (
        reconciled.filter("status = 'closed'")
        .select(F.col("active_conn_id").alias("conn_id"))
        .distinct()
    )


def usage_rollup(tracked: DataFrame, closed: DataFrame) -> DataFrame:
    """First and last time and total usage of closed sessions, by node, user,
    application, address and hardware address.

    The five groupings share one scan and one aggregation.
    """
    pairs = ", ".join(f"'{label}', {column}" for label, column in DIMENSIONS)
    return (
        tracked.join(closed, "conn_id", "left_semi")
        .select(
            F.expr(f"stack({len(DIMENSIONS)}, {pairs}) AS (usage_type, name)"),
            "first_ts",
            "last_ts",
            (F.col("cpu") + F.col("mem") + F.col("io")).alias("usage"),
        )
        .groupBy("usage_type", "name")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("usage").alias("usage"),
        )
    )


def purge_closed(tracked: DataFrame, closed: DataFrame) -> DataFrame:
    """Tracked sessions without the closed ones."""
    return tracked.join(closed, "conn_id", "left_anti").select(*tracked.columns)


def merge_usage(summary: DataFrame, rollup: DataFrame, rate_min: int = 1440) -> DataFrame:
    """Long-term usage after a rollup.

    A known name takes the new usage and last time, and one more active day if
    the rollup starts after its last time and ends more than ``rate_min``
    minutes after it. A new name starts with one active day. NULL names are
    skipped.
    """
    key = ["usage_type", "name"]
    new = rollup.filter(F.col("name").isNotNull()).select(
        *key,
        F.col("first_ts").alias("_first_ts"),
        F.col("last_ts").alias("_last_ts"),
        F.col("usage").alias("_usage"),
    )
    both = summary.join(new, key, "full")
    known, updated = F.col("active_days").isNotNull(), F.col("_usage").isNotNull()
    gap = boundary_diff("minute", F.col("last_ts"), F.col("_last_ts"))
    another_day = (F.col("last_ts") < F.col("_first_ts")) & (gap > rate_min)
    return both.select(
        *key,
        F.when(known, F.col("first_ts")).otherwise(F.col("_first_ts")).alias("first_ts"),
        F.when(updated, F.col("_last_ts")).otherwise(F.col("last_ts")).alias("last_ts"),
        F.when(~known, F.lit(1))
        .when(updated & another_day, F.col("active_days") + 1)
        .otherwise(F.col("active_days"))
        .alias("active_days"),
        F.when(updated, F.col("_usage")).otherwise(F.col("usage")).alias("usage"),
    )

"""Replication configuration, queue and backfill analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.time import (
    MINUTE,
    as_datetime,
    boundary_diff,
    div,
    floor_div,
    micros,
    midnight,
    shift,
    to_us,
    ts_lit,
)

# Replication types and their names (fixed values).
TYPE_NAMES = {1: "Simple", 2: "Analog Summary", 3: "State Summary"}
SIMPLE, ANALOG_SUMMARY, STATE_SUMMARY = 1, 2, 3

# Tag types, raw types, acquisition type and names left out (fixed values).
ANALOG_TAG, DISCRETE_TAG, STRING_TAG, EVENT_TAG, SUMMARY_TAG = 1, 2, 3, 5, 7
FLOAT_RAW_TYPES, INTEGER_RAW_TYPE = (1, 2, 4), 3
SYSTEM_ACQUISITION = 3
REPLICATED_BY = "ReplicationService"
LOCAL_SERVER = "Local Replication"

# Group selectors (fixed values).
ALL_GROUPS, SIMPLE_GROUPS, NO_GROUPS = "*", "(Simple)", "(None)"

# Limits on the queue (fixed values).
OLD_AFTER_DAYS, MAX_QUEUE, MAX_QUEUE_DAYS = 3, 500, 5

# Status messages (fixed values).
MESSAGES = {
    "begin": "{id} Beginning backfill for {count} tags from '{start}' to '{end}'",
    "added": "{id} Added {count} items from {start} to {end}",
    "remaining": "Backfilling remaining {count} items starting at {start}",
    "timed_out": "{id} backfill timed out",
    "completed": "{id} completed",
}
STATUS_PATTERNS = ("%Beginning backfill for%", "%Added % items from%")
STATUS_TAG_PREFIX = "SysReplicationSyncQueueItems"


def replication_config(
    entities: DataFrame, groups: DataFrame, servers: DataFrame
) -> DataFrame:
    """Replicated tags per server, group and replication type.

    Entities are counted by key before the names are joined on.
    """
    counted = entities.groupBy("server_key", "group_key").agg(F.count("*").alias("n"))
    kind = F.lit("Unknown")
    for key, name in TYPE_NAMES.items():
        kind = F.when(F.col("type_key") == key, name).otherwise(kind)
    named = (
        counted.join(groups.select("group_key", F.col("name").alias("group"), "type_key"), "group_key")
        .join(servers.select("server_key", F.col("name").alias("server")), "server_key")
        .groupBy("server", "group", "type_key")
        .agg(F.sum("n").alias("tags"))
    )
    return named.select("server", "group", kind.alias("type"), "tags").orderBy(
        "server", "group", "type"
    )


def entities_per_tag(entities: DataFrame) -> DataFrame:
    """Replication entities per source tag, most first."""
    return (
        entities.groupBy("source_tag")
        .agg(F.count("*").alias("entities"))
        .orderBy(F.desc("entities"), "source_tag")
    )


def queue_summary(queue: DataFrame, servers: DataFrame) -> DataFrame:
    """Queued requests per server, tag and version: span, average length, age."""
    minutes = boundary_diff("minute", F.col("mod_start_utc"), F.col("mod_end_utc"))
    per_tag = queue.groupBy("server_key", "source_tag", "request_version").agg(
        # An average of whole minutes is itself a whole number.
        div(F.sum(minutes), F.count(minutes)).alias("avg_mins"),
        F.min("mod_start_utc").alias("oldest"),
        F.max("mod_end_utc").alias("newest"),
        F.count("*").alias("entries"),
    )
    return (
        per_tag.join(servers.select("server_key", F.col("name").alias("server")), "server_key")
        .select(
            "source_tag",
            boundary_diff("hour", F.col("oldest"), F.col("newest")).alias("span_hours"),
            "avg_mins",
            "oldest",
            "newest",
            "entries",
            "request_version",
            "server",
        )
        .orderBy("source_tag", "request_version", "server")
    )


def status_log(annotations: DataFrame, users: DataFrame, now, days: int = 30) -> DataFrame:
    """Backfill status annotations since ``days`` before the last midnight."""
    begun, added = (F.col("content").like(p) for p in STATUS_PATTERNS)
    return (
        annotations.filter(F.col("date_created") >= ts_lit(midnight(now, -days)))
        .filter(begun | added)
        .join(users, "user_key", "left")
        .select("content", "user_name", "date_created", "tag")
    )


def resolve_groups(groups: DataFrame, selector: str) -> DataFrame:
    """Groups by selector: all, the simple ones, none, or those of a name."""
    if selector == ALL_GROUPS:
        return groups
    if selector == SIMPLE_GROUPS:
        return groups.filter(F.col("type_key") == SIMPLE)
    if selector == NO_GROUPS:
        return groups.limit(0)
    return groups.filter(F.col("name") == selector)


def compatible_types() -> Column:
    """Replication types a tag may have, as an array over the tag's columns."""
    tag_type, raw = F.col("tag_type"), F.col("raw_type")
    analog = (tag_type == ANALOG_TAG) & (raw.isin(*FLOAT_RAW_TYPES) | (raw == INTEGER_RAW_TYPE))
    state = ((tag_type == ANALOG_TAG) & (raw == INTEGER_RAW_TYPE)) | tag_type.isin(
        DISCRETE_TAG, STRING_TAG
    )
    return F.array_compact(
        F.array(
            F.lit(SIMPLE), F.when(analog, F.lit(ANALOG_SUMMARY)), F.when(state, F.lit(STATE_SUMMARY))
        )
    )


def _bucket(column: str, spread: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(spread)).cast("int").alias("bucket")


def _per_bucket(df: DataFrame, spread: int) -> DataFrame:
    """Each row of a small table once per bucket."""
    return df.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))


def missing_replication(
    tag: DataFrame,
    groups: DataFrame,
    entities: DataFrame,
    servers: DataFrame,
    excluded: DataFrame,
    spread: int = 32,
) -> DataFrame:
    """Tag and group pairs not yet replicated whose types go together.

    System, event, summary and replicated tags, the tags in ``excluded`` and
    groups on the local server are left out. Tags meet groups on replication
    type; as there are few types, tags are spread over ``spread`` buckets per
    type and the groups, a configuration table, are repeated per bucket.
    """
    eligible = tag.filter(
        (F.col("acquisition_type") != SYSTEM_ACQUISITION)
        & ~F.col("tag_type").isin(EVENT_TAG, SUMMARY_TAG)
        & (F.col("created_by") != REPLICATED_BY)
    )
    typed = (
        eligible.join(excluded.select("tag"), "tag", "left_anti")
        .select(
            "tag",
            F.explode(compatible_types()).alias("type_key"),
            _bucket("tag", spread),
        )
    )
    targets = _per_bucket(
        groups.join(servers.select("server_key", F.col("name").alias("server")), "server_key")
        .filter(F.col("server") != LOCAL_SERVER)
        .select("group_key", F.col("name").alias("group"), "server", "type_key"),
        spread,
    )
    existing = entities.select(F.col("source_tag").alias("tag"), "group_key")
    return (
        typed.join(targets, ["type_key", "bucket"])
        .join(existing, ["tag", "group_key"], "left_anti")
        .select(F.col("tag").alias("source_tag"), "group", "server", "type_key")
    )


def queue_guards(
    queue: DataFrame,
    now_utc,
    server: int | None = None,
    period: tuple | None = None,
    pattern: str = "%",
    servers: DataFrame | None = None,
) -> DataFrame:
    """Checks made before a backfill, in one pass over the queue.

    One row per server, or one row for ``server``: queue size, entries more
    than three days old and the days they span, entries already there for
    ``period`` (UTC start and end), and whether a backfill may start. With
    ``servers`` those without any entry have a row too.
    """
    age = boundary_diff("day", F.col("mod_end_utc"), ts_lit(now_utc))
    old = age > OLD_AFTER_DAYS
    if period is None:
        queued = F.lit(False)
    else:
        queued = F.col("mod_end_utc").between(ts_lit(period[0]), ts_lit(period[1])) & F.col(
            "source_tag"
        ).like(pattern)
    if server is None:
        grouped = queue.groupBy("server_key")
    else:
        grouped = queue.filter(F.col("server_key") == server).groupBy()
    checked = grouped.agg(
        F.count("*").alias("queue_size"),
        F.count_if(old).alias("old_entries"),
        boundary_diff(
            "day",
            F.min(F.when(old, F.col("mod_start_utc"))),
            F.max(F.when(old, F.col("mod_end_utc"))),
        ).alias("queue_days"),
        F.count_if(queued).alias("period_entries"),
    )
    if servers is not None and server is None:
        counts = ["queue_size", "old_entries", "period_entries"]
        known = servers.select("server_key").distinct()
        checked = known.join(checked, "server_key", "full").fillna(0, counts)
    refusal = (
        F.when(F.col("old_entries") > 0, "old entries")
        .when(F.col("queue_size") > MAX_QUEUE, "too many entries")
        .when(F.col("queue_days") > MAX_QUEUE_DAYS, "too many days")
        .when(F.col("period_entries") > 0, "period already queued")
    )
    return checked.withColumn("refusal", refusal).withColumn("may_start", refusal.isNull())


def backfill_windows(blocks: DataFrame, oldest, newest, now) -> DataFrame:
    """Windows to backfill, newest first, one per history block.

    The block in force at ``newest`` is always taken, from ``oldest`` if it
    starts before; earlier blocks are taken when they start at or after
    ``oldest``. Of blocks starting in one minute the longest counts. All
    arguments are local times; the block in force ends no later than ``now``.
    """
    newest = min(as_datetime(newest), as_datetime(now))
    minute = floor_div(micros(F.col("from_ts")), MINUTE)
    hours = boundary_diff("hour", F.col("from_ts"), F.col("to_ts"))
    longest = Window.partitionBy("minute").orderBy(F.desc("hours"), F.desc("to_ts"), "from_ts")
    per_minute = (
        blocks.withColumn("minute", minute)
        .withColumn("hours", hours)
        .filter(F.col("minute") <= to_us(newest) // MINUTE)
        .withColumn("rank", F.row_number().over(longest))
        .filter("rank = 1")
    )
    newest_minute = (
        blocks.select(minute.alias("m"))
        .filter(F.col("m") <= to_us(newest) // MINUTE)
        .agg(F.max("m"))
        .scalar()
    )
    marked = per_minute.withColumn("is_first", F.col("minute") == newest_minute).filter(
        F.col("is_first") | (F.col("from_ts") >= ts_lit(oldest))
    )
    offset = -F.col("tz_offset_min")
    start = F.greatest(F.col("from_ts"), ts_lit(oldest))
    end = F.when(
        F.col("is_first"), F.least(F.col("to_ts"), ts_lit(now))
    ).otherwise(F.col("to_ts"))
    return (
        marked.withColumn("start_local", start)
        .withColumn("end_local", end)
        .select(
            "start_local",
            "end_local",
            shift(F.col("start_local"), minutes=offset).alias("start_utc"),
            shift(F.col("end_local"), minutes=offset).alias("end_utc"),
            "is_first",
        )
        .orderBy(F.desc("start_local"))
    )


#: A backfill of more than so many days takes summaries of at least so many minutes.
DEFAULT_PERIODS = ((90, 60), (31, 5), (7, 1))


def default_period(span_minutes: Column) -> Column:
    """Least summary period, in minutes, for a backfill of some length."""
    least = F.lit(0)
    for days, period in reversed(DEFAULT_PERIODS):
        least = F.when(span_minutes > days * 1440, period).otherwise(least)
    return least


def default_minutes(oldest, newest) -> int:
    """``default_period`` of a known span."""
    span = to_us(newest) // MINUTE - to_us(oldest) // MINUTE
    return next((period for days, period in DEFAULT_PERIODS if span > days * 1440), 0)


def period_minutes() -> Column:
    """Minutes of a schedule's period and unit; 0 without a schedule."""
    unit = F.col("unit")
    factor = F.when(unit == "Day", 1440).when(unit == "Hour", 60).when(unit == "Minute", 1).otherwise(0)
    return F.coalesce(F.col("period") * factor, F.lit(0))


def backfill_requests(
    entities: DataFrame,
    groups: DataFrame,
    schedules: DataFrame,
    queue: DataFrame,
    windows: DataFrame,
    server: int,
    now_utc,
    min_period: int = 0,
    pattern: str = "%",
    spread: int = 32,
) -> DataFrame:
    """Requests for every entity of a server and every window, less those queued.

    An entity counts when its tag matches and its group's schedule is at least
    ``min_period`` minutes long. A request starts 1 ms into its window.

    The result is by definition each entity with each window. Entities are
    spread over ``spread`` buckets and the windows, one per history block,
    repeated per bucket, so that they meet in a hash join.
    """
    start = shift(F.col("start_utc"), milliseconds=1)
    scheduled = (
        groups.join(schedules, "schedule_key", "left")
        .filter(period_minutes() >= min_period)
        .select("group_key")
    )
    wanted = (
        entities.filter((F.col("server_key") == server) & F.col("source_tag").like(pattern))
        .join(scheduled, "group_key", "left_semi")
        .select("entity_key", _bucket("entity_key", spread))
        .distinct()
    )
    spans = _per_bucket(
        windows.select(
            start.alias("mod_start_utc"), F.col("end_utc").alias("mod_end_utc")
        ).distinct(),
        spread,
    )
    queued = queue.select("entity_key", "mod_start_utc", "mod_end_utc")
    return (
        wanted.join(spans, "bucket")
        .join(queued, ["entity_key", "mod_start_utc", "mod_end_utc"], "left_anti")
        .select(
            "entity_key",
            F.lit(0).alias("request_version"),
            "mod_start_utc",
            "mod_end_utc",
            ts_lit(now_utc).alias("earliest_exec_utc"),
            F.lit(0).alias("execute_state"),
        )
    )


def backfill_eta(log: DataFrame, oldest, newest, started) -> DataFrame:
    """Expected completion at each step of a backfill.

    ``log`` has, per window done, its ``end_local`` and the time ``at_ts``. The
    estimate is NULL until something was done and some time has passed.
    """
    total = (to_us(newest) // MINUTE) - (to_us(oldest) // MINUTE)
    done = boundary_diff("minute", F.col("end_local"), ts_lit(newest))
    elapsed = boundary_diff("minute", ts_lit(started), F.col("at_ts"))
    usable = (F.col("minutes_done") > 0) & (F.col("minutes_elapsed") > 0) & F.lit(total > 0)
    rate = F.col("minutes_elapsed") / F.col("minutes_done")
    return (
        log.withColumn("minutes_done", done)
        .withColumn("minutes_elapsed", elapsed)
        .withColumn("minutes_remaining", F.when(usable, (F.lit(total) - F.col("minutes_done")) * rate))
        .withColumn("eta_ts", shift(F.col("at_ts"), minutes=F.col("minutes_remaining").cast("long")))
    )


def status_content(kind: str, **parts: Column) -> Column:
    """Text of a status message; NULL if a part is NULL."""
    pieces, rest = [], MESSAGES[kind]
    while "{" in rest:
        text, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(text), parts[name].cast("string")]
    return F.concat(*pieces, F.lit(rest))


def invocation_id(server_name: Column, at: Column, min_period: int) -> Column:
    """Opening of a status message: time, server and what is backfilled."""
    scope = f" ({min_period}+ min)" if min_period > 0 else " (all)"
    return F.concat(
        F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(" for '"), server_name, F.lit("'" + scope)
    )


def status_rows(steps: DataFrame, kind: str, server_key: Column, **parts: Column) -> DataFrame:
    """Annotation rows for steps (at_ts, user_key) of a backfill."""
    return steps.select(
        status_content(kind, **parts).alias("content"),
        "user_key",
        F.col("at_ts").alias("date_created"),
        F.concat(F.lit(STATUS_TAG_PREFIX), server_key.cast("string")).alias("tag"),
    )


def log_status(rows: DataFrame, path: str) -> None:
    """Append status rows to an annotation folder."""
    rows.write.mode("append").parquet(path)


def backfill_plan(
    entities: DataFrame,
    groups: DataFrame,
    schedules: DataFrame,
    queue: DataFrame,
    windows: DataFrame,
    servers: DataFrame,
    server: int,
    oldest,
    newest,
    now_utc,
    steps: DataFrame,
    started,
    user_key: int,
    pattern: str = "%",
    min_period: int | None = None,
    max_queue: int = MAX_QUEUE,
) -> tuple[DataFrame, DataFrame]:
    """A whole backfill: the requests to queue, and the status rows that record it.

    Without ``min_period`` the span from ``oldest`` to ``newest`` decides it. ``steps`` says when (``at_ts``) the window
    that starts at ``start_local`` was queued. The first row tells how many tags the server has, one row per window how
    many requests it added, none included, and the last that the backfill completed or, if more than ``max_queue``
    requests of the server are then queued, that it timed out.
    """
    if min_period is None:
        min_period = default_minutes(oldest, newest)
    requests = backfill_requests(
        entities, groups, schedules, queue, windows, server, now_utc, min_period, pattern
    )
    added = requests.groupBy("mod_start_utc", "mod_end_utc").agg(F.count("*").alias("added"))
    done = (
        windows.withColumn("mod_start_utc", shift(F.col("start_utc"), milliseconds=1))
        .withColumnRenamed("end_utc", "mod_end_utc")
        .join(added, ["mod_start_utc", "mod_end_utc"], "left")
        .join(steps.select("start_local", "at_ts"), "start_local")
        .select("start_local", "end_local", "at_ts", F.coalesce("added", F.lit(0)).alias("added"))
    )
    own = servers.filter(F.col("server_key") == server).select("name")
    of_server = entities.filter(F.col("server_key") == server).select("entity_key")
    size = of_server.agg(F.count("*").alias("size")).join(own)
    waiting = queue.join(of_server.distinct(), "entity_key", "left_semi").agg(F.count("*").alias("waiting"))
    last = done.agg(F.max("at_ts").alias("at_ts"), F.sum("added").alias("sent")).join(waiting).join(own)

    def text(column: Column) -> Column:
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")

    def rows(some: DataFrame, kind: str, **parts: Column) -> DataFrame:
        who = some.withColumn("user_key", F.lit(user_key))
        opening = invocation_id(F.col("name"), ts_lit(started), min_period)
        return status_rows(who, kind, F.lit(server), id=opening, **parts)

    begin = rows(
        size.withColumn("at_ts", ts_lit(started)),
        "begin",
        count=F.col("size"),
        start=text(ts_lit(oldest)),
        end=text(ts_lit(newest)),
    )
    each = rows(
        done.join(own),
        "added",
        count=F.col("added"),
        start=text(F.col("start_local")),
        end=text(F.col("end_local")),
    )
    full = F.col("waiting") + F.col("sent") > max_queue
    ended = [rows(last.filter(full if kind == "timed_out" else ~full), kind) for kind in ("timed_out", "completed")]
    return requests, begin.unionByName(each).unionByName(ended[0]).unionByName(ended[1])


def queue_by_execution(queue: DataFrame, server: int | None = None) -> DataFrame:
    """Queue entries, latest execution first, optionally of one server."""
    rows = queue if server is None else queue.filter(F.col("server_key") == server)
    return rows.orderBy(F.desc("earliest_exec_utc"), "entity_key", "mod_start_utc")


def queue_due_now(queue: DataFrame, now_utc, server: int | None = None) -> DataFrame:
    """The queue with entries made due now: those that ended more than five
    minutes ago or, given a server, all of its entries, restarted at version 0."""
    if server is None:
        due = F.col("mod_end_utc") < shift(ts_lit(now_utc), minutes=-5)
        version = F.col("request_version")
    else:
        due = F.col("server_key") == server
        version = F.when(due, 0).otherwise(F.col("request_version"))
    return queue.withColumn("request_version", version).withColumn(
        "earliest_exec_utc",
        F.when(due, ts_lit(now_utc)).otherwise(F.col("earliest_exec_utc")),
    )


def queue_purge(queue: DataFrame, before) -> DataFrame:
    """The queue without entries that end before an instant."""
    return queue.filter(
        F.col("mod_end_utc").isNull() | (F.col("mod_end_utc") >= ts_lit(before))
    )


def server_log(
    annotations: DataFrame, servers: DataFrame, server_key: int, n: int = 100
) -> DataFrame:
    """The latest ``n`` annotations that name a server."""
    name = servers.filter(F.col("server_key") == server_key).select("name").scalar()
    return (
        annotations.filter(F.contains("content", name))
        .orderBy(F.desc("date_created"), "content", "tag")
        .limit(n)
    )

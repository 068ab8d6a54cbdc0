"""Queries over tag history: scans, retrieval modes, summaries, intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions.time import midnight
from tagloom.operators import intervals, retrieval, summary
from tagloom.sources import asof, export, history, states
from tagloom.session import scratch_dir
from tagloom.workload.registry import query, rounded, rounded_sql
from tagloom.workload.sqltext import (
    DAY_US,
    HOUR_US,
    STATE_COLUMNS,
    SUMMARY_COLUMNS,
    bounded_rows,
    runs_ctes,
    select,
    state_ctes,
    summary_ctes,
)
from tagloom.workload.tables import END, MIDDLE, NOW, START

TAGS = ["click", "error", "purchase", "signup", "view"]
# Tags with few samples each: a block may span the whole range.
SPARSE_MS = 30 * 86_400_000
S, E = f"{START} 00:00:00", f"{END} 00:00:00"
TZ = "America/New_York"


# Scans and sinks


@query(
    "scan_history",
    f"SELECT tag, ts, value, quality FROM history WHERE ts > TS'{S}' AND ts <= TS'{E}'",
)
def _(t):
    return history.scan_history(t.history, TAGS, START, END, "(]")


@query(
    "for_tags",
    """SELECT tag, ts, value, quality FROM user_history
       WHERE tag IN (SELECT concat('', c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def _(t):
    wanted = t.customer.filter("c_mktsegment = 'BUILDING'")
    return history.for_tags(t.user_history, wanted.select(F.col("c_custkey").cast("string").alias("tag")))


@query(
    "live",
    """SELECT tag, ts, value, quality FROM user_history
       QUALIFY row_number() OVER (PARTITION BY tag ORDER BY ts DESC) = 1""",
)
def _(t):
    return history.live(t.user_history)


@query(
    "in_time_zone",
    f"SELECT tag, ts AT TIME ZONE 'UTC' AT TIME ZONE '{TZ}' AS ts, value, quality FROM order_history",
)
def _(t):
    return history.in_time_zone(t.order_history, TZ)


@query(
    "latest_version",
    """SELECT tag, ts, version, value, price FROM versioned
       QUALIFY row_number() OVER (PARTITION BY tag, ts ORDER BY version DESC) = 1""",
)
def _(t):
    return history.latest_version(t.versioned)


LINE = """concat(tag, '|0|', strftime(ts, '%Y/%m/%d'), '|', strftime(ts, '%H:%M:%S.%g'), '|0|',
                 CAST(value AS VARCHAR), '|', quality)"""


@query(
    "fastload_lines",
    f"SELECT CASE WHEN value IS NOT NULL THEN {LINE} END AS line FROM history",
)
def _(t):
    return export.fastload_lines(t.history)


DELTA_ROWS = f"""r AS (SELECT tag, epoch_us(ts) AS us, ts, value, quality FROM history
                       WHERE ts > TS'{S}' AND ts <= TS'{E}')"""
DELTA = runs_ctes("d", "r", "{'v': value, 'q': quality}")


@query(
    "export_next",
    f"WITH {DELTA_ROWS}, {DELTA} SELECT {LINE} AS line FROM d WHERE value IS NOT NULL",
)
def _(t):
    """The bookmarked export run slice by slice until nothing is left."""
    folder = scratch_dir(t.spark, "export")
    export.set_bookmark(t.spark, f"{folder}/bookmark", *(midnight(x) for x in (START, END)))
    # Listed once: every slice would look through all history for the tags.
    t.history.select("tag").distinct().write.parquet(f"{folder}/tags")
    tags = t.spark.read.schema("tag string").parquet(f"{folder}/tags")
    while export.export_next(t.history, tags, f"{folder}/bookmark", f"{folder}/out", hours=24):
        pass
    return t.spark.read.text(f"{folder}/out/export-*/data").withColumnRenamed("value", "line")


@query(
    "tags_in_group",
    """SELECT DISTINCT c.tag FROM ns n JOIN group_tag g ON g.name_key = n.name_key
       JOIN tag_ref f ON f.domain_tag_key = g.domain_tag_key JOIN customer_tag c ON c.tag = f.tag
       WHERE n.name = 'NATION_7' AND c.date_created < TS'1996-01-01 00:00:00'""",
)
def _(t):
    return export.tags_in_group(
        t.ns, t.group_tag, t.tag_ref, t.customer_tag, "NATION_7", "1996-01-01"
    )


HOURLY = summary_ctes("s", "history", S, E, HOUR_US)


@query(
    "append_samples",
    f"""WITH {HOURLY} SELECT tag, start_ts AS ts, round(average, 4) AS value,
        CASE WHEN average IS NULL THEN 0 ELSE 192 END AS quality FROM s""",
)
def _(t):
    """Hourly averages written back as samples."""
    hourly = summary.analog_summary(t.history, START, END, summary.HOUR_MS)
    folder = scratch_dir(t.spark, "history")
    history.append_samples(
        hourly.select(
            "tag",
            F.col("start_ts").alias("ts"),
            F.round("average", 4).alias("value"),
            F.when(F.col("average").isNull(), 0).otherwise(192).alias("quality"),
        ),
        folder,
    )
    return history.read_history(t.spark, folder).select("tag", "ts", "value", "quality")


def _indexed(t):
    """History in days with an index of every third day; its first half comes last, as late samples do."""
    folder = scratch_dir(t.spark, "indexed")
    middle = F.lit(midnight(MIDDLE))
    for part in (F.col("ts") >= middle, F.col("ts") < middle):
        asof.append_indexed(t.history.filter(part), f"{folder}/history", f"{folder}/index", every=3)
    return asof.read_since(t.spark, f"{folder}/history", f"{folder}/index", LATE)


LATE = "2024-01-27"
LATE_HOURLY = summary_ctes("s", "history", f"{LATE} 00:00:00", E, HOUR_US)


@query("as_of_summary", f"WITH {LATE_HOURLY} {select('s', SUMMARY_COLUMNS)}")
def _(t):
    """Hourly summaries of the last days, from these days and one link of the index."""
    return rounded(summary.analog_summary(_indexed(t), LATE, END, summary.HOUR_MS))


@query(
    "as_of_start_bound",
    f"""SELECT tag, TS'{LATE} 06:00:00' AS ts, value, quality, ts AS sampled_ts FROM history
        WHERE ts <= TS'{LATE} 06:00:00'
        QUALIFY row_number() OVER (PARTITION BY tag ORDER BY ts DESC) = 1""",
)
def _(t):
    return history.start_bound(_indexed(t), f"{LATE} 06:00:00")


# Retrieval modes


@query(
    "delta",
    f"""WITH r AS (SELECT tag, epoch_us(ts) AS us, ts, value, quality FROM discrete
                   WHERE ts > TS'{S}' AND ts < TS'{E}'),
        {DELTA} SELECT tag, ts, value, quality, (end_us - us) // 1000 AS duration_ms FROM d""",
)
def _(t):
    return retrieval.delta(t.discrete, START, END)


@query(
    "start_bound",
    f"""SELECT tag, TS'{MIDDLE} 00:00:00' AS ts, value, quality, ts AS sampled_ts FROM user_history
        WHERE ts <= TS'{MIDDLE} 00:00:00'
        QUALIFY row_number() OVER (PARTITION BY tag ORDER BY ts DESC) = 1""",
)
def _(t):
    return history.start_bound(t.user_history, MIDDLE)


def _cyclic_sql(cycles: int, width_us: int) -> str:
    return f"""WITH g AS (
          SELECT t.tag, TS'{S}' + to_microseconds(k * {width_us}) AS ts
          FROM (SELECT DISTINCT tag FROM history) t, generate_series(0, {cycles - 1}) AS x(k))
        SELECT g.tag, g.ts, CASE WHEN h.quality = 192 THEN h.value END AS value
        FROM g ASOF LEFT JOIN history h ON h.tag = g.tag AND h.ts <= g.ts"""


@query("cyclic_resolution", _cyclic_sql(720, HOUR_US))
def _(t):
    return retrieval.cyclic(t.history, START, END, resolution_ms=summary.HOUR_MS)


@query("cyclic_count", _cyclic_sql(24, 30 * HOUR_US))
def _(t):
    return retrieval.cyclic(t.history, START, END, cycles=24)


EDGE_ROWS = f"""r AS (SELECT tag, epoch_us(ts) AS us, ts, value, quality,
                             coalesce(value > 95, false) AS hot
                      FROM history WHERE ts <= TS'{E}'),
                {runs_ctes("d", "r", "hot")}"""
EDGE_COLUMNS = """tag, ts, value, quality, CASE WHEN hot THEN 'leading' ELSE 'trailing' END AS edge,
                  (end_us - us) // 1000 AS duration_ms"""


@query(
    "edges_leading",
    f"WITH {EDGE_ROWS} SELECT {EDGE_COLUMNS} FROM d WHERE hot AND ts >= TS'{MIDDLE} 00:00:00'",
)
def _(t):
    return retrieval.edges(t.history, F.col("value") > 95, "leading", MIDDLE, END)


@query(
    "edges_both",
    f"WITH {EDGE_ROWS} SELECT {EDGE_COLUMNS} FROM d WHERE (hot OR run > 1) AND ts >= TS'{S}'",
)
def _(t):
    return retrieval.edges(t.history, F.col("value") > 95, "both", START, END)


def _wide_sql(source: str, tags: list[str]) -> str:
    """One row per change instant, each tag's value found as of that instant."""
    columns = ", ".join(f"w{i}.v AS {tag}" for i, tag in enumerate(tags))
    joins = " ".join(
        f"ASOF LEFT JOIN (SELECT us, v FROM c WHERE tag = '{tag}') w{i} ON w{i}.us <= p.us"
        for i, tag in enumerate(tags)
    )
    names = ", ".join(f"'{tag}'" for tag in tags)
    return f"""{bounded_rows("b0", source, S, E, closed_end=True)},
        b AS (SELECT * FROM b0 WHERE tag IN ({names})),
        {runs_ctes("c", "b", "v")},
        p AS (SELECT DISTINCT us FROM c),
        w AS (SELECT p.us, {columns}, lead(p.us) OVER (ORDER BY p.us) AS next_us FROM p {joins})"""


@query(
    "wide",
    f"""WITH {_wide_sql("history", TAGS)}
        SELECT make_timestamp(us) AS ts, {", ".join(TAGS)}, (next_us - us) // 1000 AS duration_ms
        FROM w""",
)
def _(t):
    return retrieval.wide(t.history, TAGS, START, END)


# Summaries


@query("analog_summary_hourly", f"WITH {HOURLY} {select('s', SUMMARY_COLUMNS)}")
def _(t):
    return rounded(summary.analog_summary(t.history, START, END, summary.HOUR_MS))


@query(
    "analog_summary_users",
    f"WITH {summary_ctes('s', 'user_history', S, E, 5 * DAY_US)} {select('s', SUMMARY_COLUMNS)}",
)
def _(t):
    """Many sparse tags, six cycles."""
    return rounded(
        summary.analog_summary(
            t.user_history, START, END, 5 * summary.DAY_MS, block_ms=SPARSE_MS
        )
    )


FULL = summary_ctes("s", "history", S, E, 30 * DAY_US)


@query("full_summary", f"WITH {FULL} {select('s', SUMMARY_COLUMNS)}")
def _(t):
    return rounded(summary.full_summary(t.history, START, END))


DAILY_STATES = state_ctes("z", "discrete", S, E, DAY_US)
ALL_STATES = state_ctes("z", "discrete", S, E, 30 * DAY_US)


@query("state_summary", f"WITH {DAILY_STATES} {select('z', STATE_COLUMNS)}")
def _(t):
    return rounded(summary.state_summary(t.discrete, START, END, summary.DAY_MS))


@query(
    "state_summary_filled",
    f"""WITH {ALL_STATES}, l AS (SELECT DISTINCT event_type AS tag FROM events
                                 UNION ALL SELECT r_name FROM region)
        SELECT l.tag, coalesce(z.state_count, 0) AS state_count, coalesce(z.state_ms, 0) AS state_ms
        FROM l LEFT JOIN z ON z.tag = l.tag AND z.state = 1""",
)
def _(t):
    """The regions are requested tags without any samples."""
    tags = t.events.select(F.col("event_type").alias("tag")).distinct()
    tags = tags.union(t.region.select("r_name"))
    return summary.state_summary_filled(t.discrete, tags, 1.0, START, END)


def _hour_of_day_sql(label: str) -> str:
    return f"""WITH {summary_ctes("s", "history", "2024-01-02 00:00:00", E, HOUR_US)}
        SELECT tag, CAST(hour(start_ts) AS INT) AS hour_of_day, {label} AS ts,
               min(minimum) AS minimum, max(maximum) AS maximum, round(avg(average), 4) AS average,
               round(stddev_pop(average), 3) AS std_dev,
               round(avg(percent_good), 4) AS percent_good, count(*) AS count
        FROM s GROUP BY tag, hour(start_ts)"""


@query("hour_of_day_rolling", _hour_of_day_sql("max(start_ts)"))
def _(t):
    return rounded(summary.hour_of_day(t.history, NOW))


@query(
    "hour_of_day_fixed",
    _hour_of_day_sql("TS'2024-02-01 00:00:00' + to_hours(CAST(hour(start_ts) AS INT) - 24)"),
)
def _(t):
    return rounded(summary.hour_of_day(t.history, NOW, mode="fixed"))


@query("hour_of_day_stored", _hour_of_day_sql("max(start_ts)"))
def _(t):
    """The rolling profile from kept states, some of whose samples came late."""
    folder = scratch_dir(t.spark, "states")
    late = F.second("ts") % 10 == 0
    for some in (~late, late):
        states.append_with_states(t.history.filter(some), f"{folder}/history", f"{folder}/states")
    kept = states.read_states(t.spark, f"{folder}/history", f"{folder}/states")
    return rounded(summary.hour_of_day(None, NOW, states=kept))


@query(
    "resource_report",
    f"""WITH {FULL}, {ALL_STATES}
        SELECT start_ts, tag, round(average, 4) AS average, minimum, maximum,
               round(std_dev, 3) AS std_dev, round(maximum - minimum, 4) AS range,
               round(percent_good, 0) AS percent_good
        FROM s
        UNION
        SELECT start_ts, concat(tag, ' (0)'), round(avg_contained_ms, 4),
               CAST(min_contained_ms AS DOUBLE), CAST(max_contained_ms AS DOUBLE),
               CAST(state_count AS DOUBLE), CAST(NULL AS DOUBLE), round(state_percent, 4)
        FROM z WHERE state = 0""",
)
def _(t):
    """Analog rows of every tag; state rows of every tag's on/off signal."""
    onoff = t.discrete.withColumn("tag", F.concat(F.lit("~"), "tag"))
    both = t.history.unionByName(onoff)
    report = summary.resource_report(both, TAGS, [f"~{x}" for x in TAGS], 0, START, END)
    return rounded(report.withColumn("tag", F.ltrim(F.col("tag"), F.lit("~"))))


@query(
    "daily_load",
    f"""WITH {summary_ctes("s", "history", S, E, DAY_US)}
        SELECT {rounded_sql("tag", "start_ts", "average", "std_dev", "maximum", "percent_good")}
        FROM s""",
)
def _(t):
    return rounded(summary.daily_load(t.history, TAGS, NOW))


# Irregular intervals


def _slice_sql(slice_value: str) -> str:
    """The rows of slicing all other tags by the on/off signal of one."""
    return f"""WITH r AS (SELECT epoch_us(ts) AS us, 's' AS tag,
                          CASE WHEN quality = 192 THEN {slice_value} END AS v
                   FROM discrete WHERE tag = 'click' AND ts > TS'{S}' AND ts < TS'{E}'),
        {runs_ctes("sl", "r", "v")},
        {bounded_rows("b0", "history", S, E)},
        b AS (SELECT * FROM b0 WHERE tag <> 'click'),
        seg AS (SELECT tag, us, v, CAST(NOT carried AS INT) AS own,
                       coalesce(lead(us) OVER (PARTITION BY tag ORDER BY us), epoch_us(TS'{E}')) AS until
                FROM b),
        x AS (SELECT sl.us AS s_us, sl.end_us, sl.v AS s_v, seg.tag, seg.v,
                     greatest(seg.us, sl.us) AS a, least(seg.until, sl.end_us) AS b,
                     CASE WHEN seg.us >= sl.us THEN seg.own ELSE 0 END AS own
              FROM sl JOIN seg ON seg.us < sl.end_us AND seg.until > sl.us
              WHERE sl.end_us IS NOT NULL),
        y AS (SELECT *, min(v) OVER p AS mn, max(v) OVER p AS mx FROM x
              WINDOW p AS (PARTITION BY tag, s_us)),
        g AS (SELECT tag, s_us, max(end_us) AS end_us, max(s_v) AS s_v, max(mn) AS mn, max(mx) AS mx,
                     min(CASE WHEN v = mn THEN a END) AS mn_us,
                     min(CASE WHEN v = mx THEN a END) AS mx_us,
                     sum(CASE WHEN v IS NOT NULL THEN b - a END) AS w, sum(own) AS n,
                     sum(v * ((b - a) / 1e6)) AS area, sum(v * v * ((b - a) / 1e6)) AS area2
              FROM y GROUP BY tag, s_us),
        -- Slices before a tag's first sample have a row without statistics.
        q AS (SELECT l.tag, sl.us, sl.end_us, sl.v FROM sl, (SELECT DISTINCT tag FROM b) l
              WHERE sl.end_us IS NOT NULL),
        z AS (SELECT q.tag, make_timestamp(q.us) AS start_ts, make_timestamp(q.end_us) AS end_ts,
                     CAST(q.v AS VARCHAR) AS slice_value, area / (w / 1e6) AS average,
                     (q.end_us - q.us) // 1000 AS duration_ms, mn AS minimum,
                     make_timestamp(mn_us) AS min_ts, mx AS maximum, make_timestamp(mx_us) AS max_ts,
                     CASE WHEN w > 0 THEN
                       sqrt(greatest(area2 / (w / 1e6) - (area / (w / 1e6)) * (area / (w / 1e6)), 0))
                     END AS std_dev,
                     area AS integral, CAST(coalesce(n, 0) AS BIGINT) AS value_count,
                     coalesce(w, 0) * 100.0 / (q.end_us - q.us) AS percent_good
              FROM q LEFT JOIN g ON g.tag = q.tag AND g.s_us = q.us)
        {select("z", ["start_ts", "end_ts", "slice_value", "tag", "average", "duration_ms",
                      "minimum", "min_ts", "maximum", "max_ts", "std_dev", "integral",
                      "value_count", "percent_good"])}"""


def _sliced(t, slice_value: str):
    signal = t.discrete.filter("tag = 'click'")
    word = F.when(F.col("value") == 1, "high").when(F.col("value") == 0, "low")
    both = t.history.filter("tag <> 'click'").withColumn("word", F.lit(None).cast("string"))
    both = both.unionByName(signal.withColumn("word", word))
    others = [x for x in TAGS if x != "click"]
    return rounded(intervals.slice_by(both, "click", others, START, END, slice_value=slice_value))


@query("slice_by", _slice_sql("value"))
def _(t):
    """All other tags sliced by the on/off signal of one."""
    return _sliced(t, "value")


@query("slice_by_text", _slice_sql("CASE value WHEN 1 THEN 'high' WHEN 0 THEN 'low' END"))
def _(t):
    """The same slices, told apart by a text."""
    return _sliced(t, "word")


@query(
    "threshold_extrema",
    f"""WITH {bounded_rows("b", "history", S, E)},
        r AS (SELECT *, CASE WHEN v <= 15 THEN 'Min' WHEN v >= 60 THEN 'Max' END AS edge FROM b),
        {runs_ctes("d", "r", "edge")},
        m AS (SELECT *, min(v) OVER p AS mn, max(v) OVER p AS mx FROM d_n
              WINDOW p AS (PARTITION BY tag, run)),
        e AS (SELECT tag, run, max(mn) AS mn, max(mx) AS mx,
                     min(CASE WHEN v = mn THEN us END) AS mn_us,
                     min(CASE WHEN v = mx THEN us END) AS mx_us
              FROM m GROUP BY tag, run)
        SELECT make_timestamp(d.us) AS start_ts, make_timestamp(d.end_us) AS end_ts, d.tag, d.edge,
               e.mn AS minimum, make_timestamp(e.mn_us) AS min_ts, e.mx AS maximum,
               make_timestamp(e.mx_us) AS max_ts,
               d.end_us // 1000 - d.us // 1000 AS duration_ms, d.v AS value
        FROM d JOIN e ON e.tag = d.tag AND e.run = d.run
        WHERE d.edge IS NOT NULL AND d.end_us IS NOT NULL""",
)
def _(t):
    return intervals.threshold_extrema(t.history, TAGS, 15.0, 60.0, START, END)


def _incidents_sql(rules: str, start: str = S, closed: bool = False) -> str:
    ended = "AND end_us IS NOT NULL" if closed else ""
    return f"""WITH rules(tag, op, lim) AS (VALUES {rules}),
        r AS (SELECT h.tag, op, lim, epoch_us(ts) AS us, value,
                     coalesce(CASE op WHEN '>' THEN value > lim ELSE value < lim END, false) AS hot
              FROM history h JOIN rules ON rules.tag = h.tag WHERE ts <= TS'{E}'),
        {runs_ctes("d", "r", "hot", "tag, op, lim")}
        SELECT DISTINCT make_timestamp(us) AS start_ts, make_timestamp(end_us) AS end_ts, tag, value,
               (end_us - us) // 1000 AS duration_ms
        FROM d WHERE hot AND us >= epoch_us(TS'{start}') {ended}"""


RULES = [("click", ">", 95), ("error", ">", 95), ("purchase", ">", 150), ("signup", "<", 5), ("view", "<", 2)]
RULES_SQL = ", ".join(f"('{a}', '{b}', {c})" for a, b, c in RULES)


@query("incidents", _incidents_sql(RULES_SQL))
def _(t):
    return intervals.incidents(t.history, RULES, START, END)


@query(
    "incidents_capacity",
    _incidents_sql(
        "('view', '>', 0.95 * 100), ('error', '>', 95.0 / 16 * 4)", f"{MIDDLE} 00:00:00"
    ),
)
def _(t):
    rules = intervals.capacity_rules("view", "error", 16, 4, memory_mb=100)
    return intervals.incidents(t.history, rules, MIDDLE, END)


@query(
    "any_all",
    f"""WITH {_wide_sql("discrete", TAGS)},
        k AS (SELECT us, (next_us - us) // 1000 AS ms, {" + ".join(TAGS)} AS total FROM w)
        SELECT make_timestamp(min(us)) AS start_ts, make_timestamp(max(us + ms * 1000)) AS end_ts,
               {", ".join(
                   f"CAST(sum(CASE WHEN {test} THEN ms ELSE 0 END) AS BIGINT) AS {n}_ms, "
                   f"CAST(sum(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS {n}_count"
                   for n, test in (("none", "total = 0"), ("all", f"total = {len(TAGS)}"),
                                   ("any", "total > 0")))},
               count(*) AS change_count,
               CAST(sum(CASE WHEN ms IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS not_final
        FROM k""",
)
def _(t):
    return intervals.any_all(t.discrete, TAGS, START, END)


STATISTICS = ["minimum", "min_ts", "maximum", "max_ts", "average", "std_dev", "integral", "value_count", "percent_good"]


@query(
    "within_incidents",
    f"""WITH i AS (SELECT tag AS incident_tag, start_ts, end_ts, duration_ms, epoch_us(start_ts) AS f, epoch_us(end_ts) AS t
                   FROM ({_incidents_sql(RULES_SQL, closed=True)})),
        {bounded_rows("b", "history", S, E)},
        s AS (SELECT tag, us, v, coalesce(lead(us) OVER (PARTITION BY tag ORDER BY us), epoch_us(TS'{E}')) AS until FROM b),
        p AS (SELECT i.*, s.tag, greatest(s.us, f) AS a, least(until, t) AS z, v, CASE WHEN s.us >= f THEN 1 ELSE 0 END AS own
              FROM i JOIN s ON s.us < i.t AND s.until > i.f AND s.until > s.us),
        g AS (SELECT incident_tag, start_ts, end_ts, duration_ms, f, t, tag, min(v) AS minimum, min_by(a, (v, a)) FILTER (v IS NOT NULL) AS mn_us,
                     max(v) AS maximum, min_by(a, (-v, a)) FILTER (v IS NOT NULL) AS mx_us, sum(own) AS n,
                     sum(CASE WHEN v IS NOT NULL THEN z - a END) AS w,
                     sum(v * ((z - a) / 1e6)) AS area, sum(v * v * ((z - a) / 1e6)) AS area2
              FROM p GROUP BY ALL),
        q AS (SELECT *, make_timestamp(mn_us) AS min_ts, make_timestamp(mx_us) AS max_ts, area / (w / 1e6) AS average,
                     CASE WHEN w > 0 THEN sqrt(greatest(area2 / (w / 1e6) - (area / (w / 1e6)) * (area / (w / 1e6)), 0)) END AS std_dev,
                     area AS integral, CAST(n AS BIGINT) AS value_count, coalesce(w, 0) * 100.0 / (t - f) AS percent_good
              FROM g)
        {select("q", ["incident_tag", "start_ts", "end_ts", "duration_ms", "tag", *STATISTICS])}""",
)
def _(t):
    """What every tag did while any limit was broken; incidents of several tags overlap."""
    broken = intervals.incidents(t.history, RULES, START, END).filter("end_ts IS NOT NULL")
    spans = broken.select(F.col("tag").alias("incident_tag"), "start_ts", "end_ts", "duration_ms")
    return rounded(intervals.summarise_within(t.history, TAGS, spans, START, END))

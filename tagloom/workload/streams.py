"""The periodic jobs run over the given tables as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.session import scratch_dir
from tagloom.streaming import jobs, stateful
from tagloom.workload import series
from tagloom.workload.registry import query
from tagloom.workload.reports import MERGE, MISSING, REFRESH, excluded_tags, metrics_sql
from tagloom.workload.sqltext import runs_ctes
from tagloom.workload.tables import over


def _stream(t, table: str):
    """A file stream of one given table."""
    static = getattr(t, table)
    return t.spark.readStream.schema(static.schema).parquet(f"{t.sf_dir}/{table}*.parquet")


def _run(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _refresh(t) -> str:
    folder = scratch_dir(t.spark, "refresh")
    jobs.seed_tracked(t.tracked, f"{folder}/active")
    _run(
        jobs.refresh_usage(
            _stream(t, "events"),
            f"{folder}/active",
            f"{folder}/history",
            f"{folder}/checkpoint",
            rate_s=86400,
            prepare=lambda batch: over(batch, "sessions", "events"),
        )
    )
    return folder


@query("stream_usage_refresh", REFRESH)
def _(t):
    return jobs.read_commit(t.spark, f"{_refresh(t)}/active", jobs.USAGE_ACTIVE)


@query(
    "stream_usage_metrics",
    f"WITH refreshed AS ({REFRESH}) {metrics_sql('refreshed', '(SELECT max(ts) FROM events)', 86400)}",
)
def _(t):
    history = t.spark.read.parquet(f"{_refresh(t)}/history")
    return history.select("tag", "ts", "value", "quality")


@query(
    "stream_windowed_usage",
    """SELECT time_bucket(INTERVAL 6 HOUR, ts) AS ts, count(DISTINCT user_id) AS active_users,
              count(DISTINCT user_id % 100) AS active_nodes
       FROM events GROUP BY 1
       HAVING time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def _(t):
    """Each event is a sight of its user; windows that the watermark has not passed are still open."""
    folder = scratch_dir(t.spark, "windowed")
    sessions = _stream(t, "events").select(
        F.concat(F.lit("user"), "user_id").alias("user_name"),
        F.concat(F.lit("10.0.0."), F.col("user_id") % 100).alias("ip"),
        F.col("ts").alias("last_ts"),
    )
    counted = jobs.windowed_usage(sessions, rate_s=6 * 3600, delay="1 hour")
    _run(
        counted.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    return t.spark.read.schema(counted.schema).parquet(f"{folder}/out")


@query("stream_usage_rollup", MERGE)
def _(t):
    folder = scratch_dir(t.spark, "rollup")
    jobs.seed_tracked(t.tracked, f"{folder}/active")
    jobs.seed_tracked(t.usage_summary, f"{folder}/summary")
    _run(
        jobs.roll_up_usage(
            _stream(t, "events"),
            f"{folder}/active",
            f"{folder}/summary",
            f"{folder}/checkpoint",
            prepare=lambda batch: over(batch, "sessions", "events"),
        )
    )
    return jobs.read_commit(t.spark, f"{folder}/summary", jobs.USAGE_SUMMARY)


@query("stream_missing_replication", MISSING)
def _(t):
    folder = scratch_dir(t.spark, "replication")
    _run(
        jobs.replicate_new_tags(
            _stream(t, "part"),
            t.replication_group,
            t.entity,
            t.replication_server,
            excluded_tags(t),
            f"{folder}/out",
            f"{folder}/checkpoint",
            prepare=lambda batch: over(batch, "part_tag", "part"),
        )
    )
    return t.spark.read.parquet(f"{folder}/out").drop("batch")


@query(
    "stream_export",
    f"""WITH r AS (SELECT tag, epoch_us(ts) AS us, ts, value, quality FROM history),
        {series.DELTA} SELECT {series.LINE} AS line FROM d WHERE value IS NOT NULL""",
)
def _(t):
    folder = scratch_dir(t.spark, "export")
    _run(
        jobs.export_changes(
            _stream(t, "events"),
            f"{folder}/state",
            f"{folder}/out",
            f"{folder}/checkpoint",
            prepare=lambda batch: over(batch, "history", "events"),
        )
    )
    return t.spark.read.text(f"{folder}/out/export-*/data").withColumnRenamed("value", "line")


@query("stream_incidents", series._incidents_sql(series.RULES_SQL, closed=True))
def _(t):
    folder = scratch_dir(t.spark, "incidents")
    _run(
        jobs.follow_incidents(
            _stream(t, "events"),
            series.RULES,
            f"{folder}/state",
            f"{folder}/out",
            f"{folder}/checkpoint",
            prepare=lambda batch: over(batch, "history", "events"),
        )
    )
    return t.spark.read.parquet(f"{folder}/out").drop("batch")




# What the watermark has not passed yet is still open: an hour of delay, slots of an hour.
PASSED = "time_bucket(INTERVAL 1 HOUR, end_ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM history) - INTERVAL 1 HOUR"


def _watched(t, build):
    """All rows a stateful stream of the history gives, written by a file sink."""
    folder = scratch_dir(t.spark, "watched")
    found = build(over(_stream(t, "events"), "history", "events"))
    _run(
        found.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    return t.spark.read.schema(found.schema).parquet(f"{folder}/out")


@query(
    "watch_incidents",
    f"""WITH rules(tag, op, lim) AS (VALUES {series.RULES_SQL}),
        r AS (SELECT h.tag, op, CAST(lim AS DOUBLE) AS lim, epoch_us(ts) AS us, value,
                     coalesce(CASE op WHEN '>' THEN value > lim ELSE value < lim END, false) AS hot
              FROM history h JOIN rules ON rules.tag = h.tag),
        {runs_ctes("d", "r", "hot", "tag, op, lim")},
        i AS (SELECT make_timestamp(us) AS start_ts, make_timestamp(end_us) AS end_ts, tag, op, lim AS "limit", value,
                     (end_us - us) // 1000 AS duration_ms
              FROM d WHERE hot)
        SELECT * FROM i WHERE {PASSED}""",
)
def _(t):
    return _watched(t, lambda samples: stateful.watch_incidents(samples, series.RULES, "1 hour", 3600))


@query(
    "watch_excursions",
    f"""WITH r AS (SELECT tag, epoch_us(ts) AS us, CASE WHEN quality = 192 THEN value END AS v,
                          CASE WHEN quality <> 192 THEN NULL WHEN value <= 15 THEN 'Min' WHEN value >= 60 THEN 'Max' END AS edge
                   FROM history),
        {runs_ctes("d", "r", "edge")},
        m AS (SELECT tag, run, min(v) AS mn, min_by(us, (v, us)) AS mn_us, max(v) AS mx, min_by(us, (-v, us)) AS mx_us
              FROM d_n WHERE edge IS NOT NULL GROUP BY tag, run),
        e AS (SELECT make_timestamp(us) AS start_ts, make_timestamp(end_us) AS end_ts, tag, edge, mn AS minimum,
                     make_timestamp(mn_us) AS min_ts, mx AS maximum, make_timestamp(mx_us) AS max_ts,
                     end_us // 1000 - us // 1000 AS duration_ms, v AS value
              FROM d JOIN m USING (tag, run))
        SELECT * FROM e WHERE {PASSED}""",
)
def _(t):
    return _watched(t, lambda samples: stateful.watch_excursions(samples, series.TAGS, 15.0, 60.0, "1 hour", 3600))

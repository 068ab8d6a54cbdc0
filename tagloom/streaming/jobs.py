"""The periodic jobs as Structured Streaming queries.

Each job hands its micro-batches to the batch operators with ``foreachBatch``.
State lives in versioned folders: batch ``n`` reads the newest version below
``n`` and writes version ``n``, so a batch that is run again after a failure
leaves the same state and output. The tracked sessions are kept by two jobs,
which take turns: their folder holds commits, each made from the newest one, and
a batch that has committed already does not do so again. Old states are pruned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tagloom.functions.time import MS, div, instant, micros
from tagloom.operators.intervals import Rule, broken, with_rules
from tagloom.operators.replication import missing_replication
from tagloom.operators.usage import (
    closed_ids,
    merge_usage,
    purge_closed,
    reconcile,
    refresh_active,
    usage_metrics,
    usage_rollup,
)
from tagloom.plans.blocks import BLOCK_MS, runs
from tagloom.schemas import HISTORY, USAGE_ACTIVE, USAGE_SUMMARY
from tagloom.sources.export import write_fastload
from tagloom.sources.state import (
    committed,
    prune_commits,
    prune_versions,
    read_commit,
    read_version,
    write_commit,
    write_version,
)

Prepare = Callable[[DataFrame], DataFrame]
SEED = -1
SEED_BATCH = 0


def seed_state(df: DataFrame, path: str) -> None:
    """Give a state folder its contents before the first batch."""
    write_version(df, path, SEED)


def _each(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            step(kept, batch_id)
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def _same(df: DataFrame) -> DataFrame:
    return df


def seed_tracked(df: DataFrame, path: str) -> None:
    """Give the folder of tracked (or summarised) sessions its first commit."""
    write_commit(df, path, "seed", SEED_BATCH)


def latest_sessions(sessions: DataFrame) -> DataFrame:
    """The sessions of a batch's newest snapshot, each with its last row.

    With a column ``snapshot_ts`` a batch may hold several snapshots, of which
    the newest alone says which sessions are there; without it a batch is one
    snapshot. A snapshot must not be cut over batches.
    """
    if "snapshot_ts" in sessions.columns:
        newest = sessions.agg(F.max("snapshot_ts")).scalar()
        sessions = sessions.filter(F.col("snapshot_ts") == newest).drop("snapshot_ts")
    key = ["user_name", "node", "conn_id", "application"]
    rest = ["last_ts", *(c for c in sessions.columns if c not in key and c != "last_ts")]
    newest = F.max(F.struct(*rest)).alias("_newest")
    return sessions.groupBy(*key).agg(newest).select(*key, "_newest.*")


def refresh_usage(
    sessions: DataFrame,
    active_path: str,
    history_path: str,
    checkpoint: str,
    rate_s: int = 60,
    prepare: Prepare = _same,
) -> DataStreamWriter:
    """Keep the tracked sessions and emit the four usage metrics per batch,
    stamped at the floored time of the newest session."""

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        current = latest_sessions(prepare(batch))
        tracked = read_commit(spark, active_path, USAGE_ACTIVE)
        made = write_commit(refresh_active(tracked, current), active_path, "refresh", n)
        refreshed = read_commit(spark, active_path, USAGE_ACTIVE, made)
        now = current.agg(F.max("last_ts")).first()[0]
        if now is not None:
            metrics = usage_metrics(refreshed, now, rate_s)
            metrics.write.mode("overwrite").parquet(f"{history_path}/batch={n}")
        prune_commits(spark, active_path)

    return _each(sessions, checkpoint, step)


def roll_up_usage(
    sessions: DataFrame,
    active_path: str,
    summary_path: str,
    checkpoint: str,
    rate_min: int = 1440,
    prepare: Prepare = _same,
) -> DataStreamWriter:
    """Move tracked sessions that a snapshot no longer has into the long-term
    summary. Run it with ``trigger(availableNow=True)`` once a day.

    The closed sessions of a batch are written first, then the summary with
    them, then the tracked sessions without them. A batch that is run again goes
    on with the closed sessions it had found.
    """
    closed_path = f"{summary_path}/closed"

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        if committed(spark, active_path, "rollup", n):
            return
        tracked = read_commit(spark, active_path, USAGE_ACTIVE)
        found = closed_ids(reconcile(latest_sessions(prepare(batch)), tracked))
        closed = read_commit(spark, closed_path, "conn_id string", write_commit(found, closed_path, "rollup", n))
        summary = read_commit(spark, summary_path, USAGE_SUMMARY)
        merged = merge_usage(summary, usage_rollup(tracked, closed), rate_min)
        write_commit(merged, summary_path, "rollup", n)
        write_commit(purge_closed(tracked, closed), active_path, "rollup", n)
        for path in (active_path, summary_path, closed_path):
            prune_commits(spark, path)

    return _each(sessions, checkpoint, step)


def windowed_usage(sessions: DataFrame, rate_s: int = 60, delay: str = "5 minutes") -> DataFrame:
    """Users and addresses seen per time window of a stream, counted exactly.

    Rows may come in any order within ``delay``; a window is final, and given, once the watermark has passed its end, and
    its state is then dropped. Each name is let through once per window and kind, spread by all three, and only these are
    counted, so a busy window is not one task's work. Missing names are not counted; a window of nothing else has zeros.
    """
    kinds = F.explode(
        F.array(
            F.struct(F.lit("user").alias("kind"), F.col("user_name").alias("name")),
            F.struct(F.lit("node").alias("kind"), F.col("ip").alias("name")),
        )
    )
    seen = (
        sessions.withColumn("seen", F.col("last_ts").cast("timestamp"))
        .withWatermark("seen", delay)
        .select(F.window("seen", f"{rate_s} seconds").alias("window"), kinds.alias("k"))
        .select("window", "k.kind", "k.name")
        .dropDuplicates(["window", "kind", "name"])
    )
    named = F.col("name").isNotNull()
    return (
        seen.groupBy("window")
        .agg(
            F.count_if(named & (F.col("kind") == "user")).alias("active_users"),
            F.count_if(named & (F.col("kind") == "node")).alias("active_nodes"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("ts"), "active_users", "active_nodes"
        )
    )


def replicate_new_tags(
    tags: DataFrame,
    groups: DataFrame,
    entities: DataFrame,
    servers: DataFrame,
    excluded: DataFrame,
    out_path: str,
    checkpoint: str,
    prepare: Prepare = _same,
) -> DataStreamWriter:
    """Missing replication of newly arrived tags, one output folder per batch."""

    def step(batch: DataFrame, n: int) -> None:
        missing = missing_replication(prepare(batch), groups, entities, servers, excluded)
        missing.write.mode("overwrite").parquet(f"{out_path}/batch={n}")

    return _each(tags, checkpoint, step)


def export_changes(
    samples: DataFrame,
    state_path: str,
    out_path: str,
    checkpoint: str,
    origin: str = "tagloom",
    prepare: Prepare = _same,
    block_ms: int = BLOCK_MS,
) -> DataStreamWriter:
    """Export the changes among newly arrived samples; the checkpoint is the
    bookmark and the last sample of each tag the state.

    Batches must not go back in time within a tag.
    """

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        last = read_version(spark, state_path, HISTORY, before=n)
        columns = ["tag", "ts", "value", "quality"]
        rows = last.withColumn("old", F.lit(True)).unionByName(
            prepare(batch).select(*columns).withColumn("old", F.lit(False))
        )
        changes = runs(
            rows.withColumn("us", micros(F.col("ts"))), ["value", "quality"], block_ms=block_ms
        )
        write_fastload(changes.filter("NOT old"), f"{out_path}/export-{n:06d}", origin)
        # One struct, so that of several rows at one instant value and quality stay together.
        newest = rows.groupBy("tag").agg(F.max(F.struct("ts", "value", "quality")).alias("last")).select("tag", "last.*")
        write_version(newest, state_path, n)
        prune_versions(spark, state_path)

    return _each(samples, checkpoint, step)


INCIDENT_STATE = "tag string, op string, limit double, us bigint, value double, on boolean"


def follow_incidents(
    samples: DataFrame,
    rules: Sequence[Rule],
    state_path: str,
    out_path: str,
    checkpoint: str,
    prepare: Prepare = _same,
    block_ms: int = BLOCK_MS,
) -> DataStreamWriter:
    """Emit each limit incident once it has ended.

    The state holds the first sample of the stretch each tag and rule is in,
    so a batch is evaluated as if it followed that sample, by the same plan as
    in batch and split in time blocks likewise: a busy tag does not end up in
    one stateful task. Batches must not go back in time within a tag.
    """

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        held = read_version(spark, state_path, INCIDENT_STATE, before=n)
        arrived = (
            with_rules(prepare(batch), rules)
            .select(
                "tag",
                "op",
                "limit",
                micros(F.col("ts")).alias("us"),
                "value",
                broken(F.col("value"), F.col("op"), F.col("limit")).alias("on"),
            )
        )
        stretches = runs(
            held.unionByName(arrived), ["on"], keys=["tag", "op", "limit"], block_ms=block_ms
        ).persist()
        ended = stretches.filter("on AND end_us IS NOT NULL").select(
            instant(F.col("us")).alias("start_ts"),
            instant(F.col("end_us")).alias("end_ts"),
            "tag",
            "value",
            div(F.col("end_us") - F.col("us"), MS).alias("duration_ms"),
        )
        ended.write.mode("overwrite").parquet(f"{out_path}/batch={n}")
        write_version(
            stretches.filter("end_us IS NULL").select("tag", "op", "limit", "us", "value", "on"),
            state_path,
            n,
        )
        stretches.unpersist()
        prune_versions(spark, state_path)

    return _each(samples, checkpoint, step)

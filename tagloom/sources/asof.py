"""As-of index of a history folder: the last sample of every tag at the end of days.

Most questions about a range need the values in force at its start, and so the last sample of each tag however long ago. The
index is a chain of such samples, one link for each ``every`` days, kept in step by ``append_indexed``. ``read_since`` gives a
history that begins with the nearest link and reads only the days after it, so any operator that is given it answers a range
after that day without a scan of earlier history.

The index says up to which day it may be trusted (``through``). An append first takes that back to the day before its earliest
sample, then writes, then extends the chain from the last trusted link; readers meanwhile use an older link and more days, and
an append that dies half-way leaves results right. One job at a time may append.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.time import as_datetime
from tagloom.plans.blocks import tree_neighbours
from tagloom.session import ensure
from tagloom.sources.history import append_samples, read_history
from tagloom.sources.state import prune_versions, read_version, versions, write_version

THROUGH = "through date, every int"
LINKS = "tag string, ts timestamp_ntz, value double, quality int, at date"
EPOCH = date(1970, 1, 1)


def _state(spark: SparkSession, index: str) -> tuple[date | None, int | None]:
    row = read_version(spark, f"{index}/through", THROUGH).first()
    return (row["through"], row["every"]) if row else (None, None)


def _trust(spark: SparkSession, index: str, through: date | None, every: int) -> None:
    path = f"{index}/through"
    row = spark.createDataFrame([(through, every)], THROUGH)
    write_version(row, path, (versions(spark, path) or [0])[-1] + 1)
    prune_versions(spark, path)


def _link(through: date | None, every: int, before: date | None = None) -> date | None:
    """The day of the newest link up to ``through`` (and before a day): whole multiples of ``every`` days."""
    last = through if before is None or through is None else min(through, before - timedelta(days=1))
    return last and EPOCH + timedelta(days=((last - EPOCH).days + 1) // every * every - 1)


def _links_at(spark: SparkSession, index: str, at: date) -> DataFrame:
    links = spark.read.schema(LINKS).parquet(f"{index}/links")
    return links.filter(F.col("at") == F.lit(at)).drop("at")


def _has_link(spark: SparkSession, index: str, at: date) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{index}/links/at={at}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def extend_index(spark: SparkSession, path: str, index: str, every: int = 1) -> None:
    """Bring the index up to the last day of the history at ``path``.

    Only days after the last trusted link are read. Each day's samples are reduced to the last of each tag ahead of the
    shuffle, and each of these holds until the tag's next day with samples. Links written before for the same days are
    replaced; a tag's row in a link is null-free but for its value.
    """
    ensure(spark)
    through, known = _state(spark, index)
    if known is not None and known != every:
        raise ValueError(f"this index has a link every {known} days")
    history = read_history(spark, path)
    last = history.agg(F.max("day").alias("last")).first()["last"]
    if last is None:
        return
    begin = _link(through, every)
    if begin is not None and not _has_link(spark, index, begin):
        begin = None
    rows = history
    if begin is not None:
        rows = history.filter(F.col("day") > F.lit(begin))
    # The link that ends with or after a day, by number.
    number = F.ceil((F.datediff("day", F.lit(EPOCH)) + 1) / every)
    newest = rows.withColumn("k", number).groupBy("tag", "k").agg(
        F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"), F.max_by("quality", "ts").alias("quality")
    )
    if begin is not None:
        first = ((begin - EPOCH).days + 1) // every
        base = _links_at(spark, index, begin).withColumn("k", F.lit(first).cast("long"))
        newest = newest.unionByName(base.select(*newest.columns))
    stop = ((last - EPOCH).days + 1) // every  # the last whole link
    held = tree_neighbours(newest, ["tag"], F.col("k"), "k", {}, "k")
    until = F.least(F.coalesce(F.col("_next_first") - 1, F.lit(stop)), F.lit(stop)).cast("long")
    start = F.col("k") if begin is None else F.greatest(F.col("k"), F.lit(first + 1).cast("long"))
    links = (
        held.withColumn("from_k", start)
        .withColumn("to_k", until)
        .filter("from_k <= to_k")
        .select("tag", "ts", "value", "quality", F.explode(F.sequence("from_k", "to_k")).alias("link"))
        .withColumn("at", F.date_add(F.lit(EPOCH), (F.col("link") * every - 1).cast("int")))
        .drop("link")
    )
    (
        links.repartitionByRange("at", "tag")
        .sortWithinPartitions("at", "tag")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("at")
        .parquet(f"{index}/links")
    )
    _trust(spark, index, last, every)


def append_indexed(df: DataFrame, path: str, index: str, every: int = 1) -> None:
    """``append_samples``, and the index brought into step: late samples renew the links from their day on."""
    spark = df.sparkSession
    first = df.agg(F.min(F.to_date("ts")).alias("first")).first()["first"]
    if first is None:
        return
    through, known = _state(spark, index)
    if known is not None and known != every:
        raise ValueError(f"this index has a link every {known} days")
    if through is not None and first <= through:
        _trust(spark, index, first - timedelta(days=1), every)
    append_samples(df, path)
    extend_index(spark, path, index, every)


def read_since(spark: SparkSession, path: str, index: str, start) -> DataFrame:
    """A history that answers any range from ``start`` on as the whole one does.

    Reads the nearest link before the day of ``start`` and the days after that link; all of history where there is none.
    """
    through, every = _state(spark, index)
    at = every and _link(through, every, as_datetime(start).date())
    history = read_history(spark, path)
    columns = ["tag", "ts", "value", "quality", "day"]
    if at is None or not _has_link(spark, index, at):
        return history.select(*columns)
    links = _links_at(spark, index, at).withColumn("day", F.to_date("ts"))
    return links.select(*columns).unionByName(history.filter(F.col("day") > F.lit(at)).select(*columns))

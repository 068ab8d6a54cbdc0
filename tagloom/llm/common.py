"""What several document operators share.

Documents are a table with at least ``doc_id`` (long) and ``text`` (string).
Extra columns pass through; a column that has the name of an operator's output
is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import scratch_dir

#: A lookup row that serves more than one in so many of the rows is sent to every task instead of being joined by its key;
#: there are at most so many such rows.
HEAVY_SHARE = 500


#: Rows that Spark hands to a Python worker at a time; it also keeps to its limit of bytes.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Keep Python workers small: BATCH_ROWS rows at a time, unless the session asks for fewer."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches put together until they have about ``size`` bytes."""
    held, held_size = [], 0
    for batch in batches:
        held.append(batch)
        held_size += batch.nbytes
        if held_size >= size:
            yield pa.Table.from_batches(held)
            held, held_size = [], 0
    if held:
        yield pa.Table.from_batches(held)


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, giving Arrow's unused memory back when a task's rows are done: workers outlive their tasks."""

    def rows(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns an operator is about to add."""
    lower = {n.lower() for n in names}
    return df.drop(*(c for c in df.columns if c.lower() in lower))


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lookup(rows: DataFrame, found: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``found``, which has one row per key, however skewed the keys of ``rows`` are.

    ``weight`` is the column of ``found`` with the number of rows that have the key. Keys of more than
    ``total / HEAVY_SHARE`` rows (at most ``HEAVY_SHARE`` keys) are broadcast; their rows then go through the ordinary join
    under keys of their own, spread evenly. Null keys find nothing. ``weight`` is not returned.
    """
    limit = max(1000.0, total / HEAVY_SHARE)
    values = [c for c in found.columns if c not in keys and c != weight]
    heavy = found.where(F.col(weight) > limit).select(
        *keys, F.lit(True).alias("_heavy"), *(F.col(c).alias(f"_h_{c}") for c in values)
    )
    light = found.where(F.col(weight) <= limit).select(*(F.col(k).alias(f"_j_{k}") for k in keys), *values)
    first, *others = keys
    kind = dict(rows.dtypes)[first]
    own = ["doc_id", first] if "doc_id" in rows.columns else rows.columns
    apart = F.xxhash64(*own) % F.lit(1 << 62)
    out = rows.join(F.broadcast(heavy), keys, "left")
    # A heavy row must not meet a light one: its further join keys are null, or its only key becomes one that is not there.
    if others:
        out = out.withColumn(f"_j_{first}", F.when(F.col("_heavy"), apart.cast(kind)).otherwise(F.col(first)))
        for k in others:
            out = out.withColumn(f"_j_{k}", F.when(F.col("_heavy"), F.lit(None)).otherwise(F.col(k)))
        joined = out.join(light, [f"_j_{k}" for k in keys], "left")
    else:
        out = out.withColumn(f"_j_{first}", F.when(F.col("_heavy"), apart.cast(kind)).otherwise(F.col(first)))
        out = out.withColumn("_j_on", F.when(F.col("_heavy"), F.lit(None)).otherwise(F.lit(1)))
        joined = out.join(light.withColumn("_j_on", F.lit(1)), [f"_j_{first}", "_j_on"], "left")
    return joined.select(
        *(F.col(c) for c in rows.columns),
        *(F.when(F.col("_heavy"), F.col(f"_h_{c}")).otherwise(F.col(c)).alias(c) for c in values),
    )


def id_bounds(df: DataFrame, column: str, parts: int) -> list:
    """At most ``parts - 1`` values of ``column`` that cut its rows into ranges of like counts; read from that column alone."""
    if parts < 2:
        return []
    cuts = [i / parts for i in range(1, parts)]
    found = df.select(F.percentile_approx(column, F.array(*map(F.lit, cuts)), 10 * parts).alias("b")).first()["b"]
    return sorted(set(found or []))


def range_of(column: Column, bounds: Iterable) -> Column:
    """The number of bounds at or below the value; 0 for null."""
    bounds = list(bounds)
    if not bounds:
        return F.lit(0)
    known = F.array(*map(F.lit, bounds))
    return F.coalesce(F.size(F.filter(known, lambda b: b <= column)), F.lit(0))

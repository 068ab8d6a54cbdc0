"""Mixing sources to target weights by a low-discrepancy schedule.

The points ``frac(k * golden ratio)``, held as 64-bit integers, are mapped through the cumulative target shares: each slot of
the schedule names a source, and any stretch of slots holds the sources nearly in their shares. Slots are ranked within their
source; ranks that a source needs and the points do not reach follow as slots of their own. Each source's documents are shuffled and laid end to end, as often as its target needs, and cut into blocks of equal
size; slot number r of a source takes its block r. The last block of a source ends at its target.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tagloom.llm import tokens
from tagloom.llm.common import shuffle_partitions, stored, whole_text

WEIGHTS = (5.0, 2.0, 1.0)
#: A document and a source are repeated so many times at most.
REPEATS = 3
BLOCK = 64
SEED = 20_24
#: Slots that one row of the schedule's table stands for.
STRETCH = 1 << 18
#: The recipe has one row per source, which the driver and every task hold.
MAX_SOURCES = 100_000

GOLDEN = 0x9E3779B97F4A7C15  # 2^64 / golden ratio, odd


def word_counts(texts: pa.LargeStringArray) -> np.ndarray:
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return np.zeros(n, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8, last - first, first)
    space = (data == 0x20) | (data >= 0x09) & (data <= 0x0D)
    begins = ~space
    begins[1:] &= space[:-1]
    at = offsets[:-1][offsets[:-1] < last] - first
    begins[at] = ~space[at]  # a text's first byte, whatever stood before it
    return np.diff(np.searchsorted(np.flatnonzero(begins), offsets - first))


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their size instead of their text."""
    for batch in batches:
        for part in tokens.slices(pa.Table.from_batches([batch])):
            texts = part["text"].combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            names = [c for c in part.column_names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(part[c].combine_chunks() for c in names), pa.array(word_counts(texts))], [*names, "size"])


def targets(sizes: Sequence[int], weights: Sequence[float], repeats: int = REPEATS) -> list[float]:
    """Shares of the sum of sizes by weight; what a source cannot take (``repeats`` times its size) goes to the others."""
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / weight for i in open_}
        full = [i for i in open_ if share[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share[i]
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def points(slots: np.ndarray) -> np.ndarray:
    """The low-discrepancy point of each slot, as a share of 2^64."""
    return (slots.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN)


def _schedule(limits: np.ndarray, total: int, ranked: bool):
    """Slots with source and rank (``ranked``), or the number of slots per stretch and source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first = row["stretch"] * STRETCH
                slots = np.arange(first, min(first + STRETCH, total))
                source = np.searchsorted(limits, points(slots), "right")
                if not ranked:
                    n = np.bincount(source, minlength=len(limits) + 1)
                    used = np.flatnonzero(n)
                    cols = [pa.array(np.full(len(used), row["stretch"])), pa.array(used), pa.array(n[used])]
                    yield pa.RecordBatch.from_arrays(cols, ["stretch", "at", "n"])
                    continue
                base = np.zeros(len(limits) + 1, np.int64)
                for x in row["bases"]:
                    base[x["at"]] = x["base"]
                order = np.argsort(source, kind="stable")
                runs = np.flatnonzero(np.r_[True, source[order][1:] != source[order][:-1]])
                rank = np.empty(len(slots), np.int64)
                rank[order] = np.arange(len(slots)) - np.repeat(runs, np.diff(np.r_[runs, len(slots)]))
                cols = [pa.array(slots), pa.array(source), pa.array(rank + base[source])]
                yield pa.RecordBatch.from_arrays(cols, ["slot", "at", "block"])

    return run


def sized(docs: DataFrame) -> DataFrame:
    """``key`` (a row's own number), ``doc_id``, ``source`` and ``size`` in words of every row, stored."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), whole_text().alias("text"))
    rows = given.mapInArrow(_sized, "doc_id long, source string, size long")
    return stored(rows.withColumn("key", F.monotonically_increasing_id()), "sizes")


def recipe(rows: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS) -> list[tuple]:
    """(source, its size, its target) by code point, null last; ``weights`` are dealt out in that order, over and over."""
    found = rows.groupBy("source").agg(F.sum("size")).take(MAX_SOURCES + 1)
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: name coarser ones")
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r[1]) for r in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], repeats)
    return list(zip([r[0] for r in found], sizes, goal, strict=True))


def mixture(rows: DataFrame, plan: list[tuple], block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """What each slot takes: ``slot``, ``at`` (the source's place in the plan), ``key``, ``pass``, ``first_word``, ``words``.

    ``rows`` comes from ``sized``. Two slots are apart by the words of one block (fewer in a source's last). A source meets its
    target, rounded down, exactly: where the schedule's first slots, a fiftieth more than needed, give it too few, the blocks
    that are left take slots after these.
    """
    spark = rows.sparkSession
    goals = np.array([np.floor(g) for *_, g in plan])
    total = float(goals.sum())
    need = int(-(-total // block))
    slots = need + need // 50 + 64 if total else 0
    shares = np.cumsum(goals)[:-1] / total if total else np.zeros(0)
    limits = np.array([min(int(s * 2.0**64), 2**64 - 1) for s in shares], np.uint64)
    known = spark.createDataFrame(
        [(s, i, n, int(g)) for i, ((s, n, _), g) in enumerate(zip(plan, goals, strict=True))],
        "source string, at long, source_size long, goal long",
    )
    # The order within a source, and where each document begins in it: first by ranges of the shuffling hash, then within them.
    bits = max(1, (shuffle_partitions(spark) - 1).bit_length())
    mixed = F.xxhash64(F.lit(seed), "doc_id")
    laid = (
        rows.where("size > 0")
        .withColumn("_h", mixed)
        .withColumn("_r", F.shiftrightunsigned("_h", 64 - bits))
        .join(F.broadcast(known.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s")))
        .select("key", "size", "_h", "_r", "at", "source_size", "goal")
    )
    ranges = laid.groupBy("at", "_r").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("at").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select("at", "_r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("at", "_r").orderBy("_h", "key").rowsBetween(Window.unboundedPreceding, -1)
    begins = laid.join(bases, ["at", "_r"]).withColumn("begin", F.col("base") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    turns = F.sequence(F.lit(0), F.floor((F.col("goal") - 1 - F.col("begin")) / F.col("source_size")).cast("int"))
    times = begins.where("begin < goal").withColumn("pass", F.explode(turns))
    times = times.withColumn("s", F.col("pass") * F.col("source_size") + F.col("begin"))
    times = times.withColumn("e", F.least(F.col("s") + F.col("size"), F.col("goal")))
    parts = times.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("s") / block).cast("long"), F.floor((F.col("e") - 1) / block).cast("long")))
    )
    low, high = F.greatest("s", F.col("block") * block), F.least("e", (F.col("block") + 1) * block)
    parts = parts.select("at", "block", "key", "pass", (low - F.col("s")).alias("first_word"), (high - low).alias("words"))
    # The schedule: slots per stretch and source, the ranks before each stretch, then the ranked slots.
    stretches = spark.range(-(-slots // STRETCH)).withColumnRenamed("id", "stretch")
    counts = stretches.mapInArrow(_schedule(limits, slots, False), "stretch long, at long, n long")
    earlier = Window.partitionBy("at").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    starts = starts.groupBy("stretch").agg(F.collect_list(F.struct("at", "base")).alias("bases"))  # at most a row per source
    ranked = starts.mapInArrow(_schedule(limits, slots, True), "slot long, at long, block long")
    # What the points left out, at most a row per source.
    reached = np.zeros(len(plan), np.int64)
    for at, n in counts.groupBy("at").agg(F.sum("n")).collect():
        reached[at] = n
    wanted = -(-goals.astype(np.int64) // block)
    missing = np.maximum(wanted - reached, 0)
    base = slots + np.cumsum(missing) - missing
    short = [(int(i), int(reached[i]), int(wanted[i]), int(base[i])) for i in np.flatnonzero(missing)]
    short = spark.createDataFrame(short, "at long, reached long, wanted long, base long")
    late = short.withColumn("block", F.explode(F.sequence("reached", F.col("wanted") - 1)))
    ranked = ranked.union(late.select((F.col("base") + F.col("block") - F.col("reached")).alias("slot"), "at", "block"))
    # Both sides grow with the corpus, but the schedule's size is not known before it runs: never broadcast it.
    return ranked.hint("merge").join(parts.hint("merge"), ["at", "block"]).select("slot", "at", "key", "pass", "first_word", "words")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` of every row of ``docs``.

    Null text and texts without a word have size 0 and take no part. A null source is a source; rows that repeat an id count
    each for themselves. An empty table gives no rows. Runs agree: the shuffle hashes ``seed``
    and the id, whatever the partitioning; rows that share an id follow the table's order.
    """
    rows = sized(docs)
    plan = recipe(rows, weights, repeats)
    known = docs.sparkSession.createDataFrame(plan, "_s string, source_size long, target double")
    taken = mixture(rows, plan, block, seed).groupBy("key").agg(F.sum("words").alias("taken"))
    return (
        rows.join(taken.hint("merge"), "key", "left")
        .join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_s")))
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


@F.pandas_udf(StringType())
def _first_words(text: pd.Series, words: pd.Series) -> pd.Series:
    """The text up to the end of so many words."""
    out = []
    for t, n in zip(text, words, strict=True):
        data = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
        space = (data == 0x20) | (data >= 0x09) & (data <= 0x0D)
        ends = np.flatnonzero(~space & np.r_[space[1:], True])
        out.append(t if n >= len(ends) else data[: ends[int(n) - 1] + 1].tobytes().decode("utf-8", "surrogatepass") if n else "")
    return pd.Series(out, dtype=object)


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mixture as documents: a row for each time a document is taken, cut after the words taken if not all are.

    Columns are those of ``docs``; a document of size 0, or one that its source's target leaves out, has no row.
    """
    held = stored(docs.withColumn("_key", F.monotonically_increasing_id()), "mix-documents")
    given = held.select(F.col("_key").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), whole_text().alias("text"))
    rows = stored(given.mapInArrow(_sized, "key long, doc_id long, source string, size long"), "sizes")
    times = mixture(rows, recipe(rows, weights, repeats), block, seed).groupBy("key", "pass").agg(F.sum("words").alias("_words"))
    taken = held.join(times.withColumnRenamed("key", "_key").hint("merge"), "_key")
    return taken.withColumn("text", _first_words(whole_text(), F.col("_words"))).select(*docs.columns)


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")

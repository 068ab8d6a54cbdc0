"""Exact duplicates through an extendible-hash index on shared files.

The index hashes a text to 64 bits. A directory of ``2^g`` entries, addressed by the first ``g`` bits, points to buckets;
an overfull bucket is split on its next bit, and the directory doubles when that bucket had used all ``g``. Each bucket is
a range of hash keys with one owner task. An owner reads the texts of its range in key order, chains the texts of a key
that differ, byte by byte, and writes one index row per distinct text to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.llm.common import gathered, lean, lookup, stored, without, whole_text

#: Distinct texts of a bucket before it is split.
BUCKET_ROWS = 20_000
#: Bits that the directory may use. The histogram it grows from has 2^DEPTH cells, whatever the input's size.
DEPTH = 16
#: Bytes of rows among which a task combines copies before the shuffle.
GATHERED = 16 << 20

OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")


@dataclass
class Directory:
    """Pointers by hash prefix; buckets are numbered in key order."""

    depth: int
    pointers: np.ndarray
    buckets: list[tuple[int, int]]  # prefix, local depth

    @classmethod
    def grown(cls, histogram: np.ndarray, capacity: int = BUCKET_ROWS) -> Directory:
        """The directory after all keys are in: ``histogram`` counts keys by their first bits, a power of two of cells."""
        bits = len(histogram).bit_length() - 1
        below = np.concatenate([[0], np.cumsum(histogram)])
        depth, pointers = 0, np.zeros(1, np.int64)
        buckets: list[tuple[int, int]] = [(0, 0)]
        full = [0]
        while full:
            at = full.pop()
            prefix, local = buckets[at]
            size = 1 << (bits - local)
            held = below[(prefix + 1) * size] - below[prefix * size]
            if held <= capacity or local == bits:
                continue  # keys that agree in all bits of the histogram stay together
            if local == depth:
                pointers, depth = np.repeat(pointers, 2), depth + 1
            buckets[at] = (2 * prefix, local + 1)
            buckets.append((2 * prefix + 1, local + 1))
            reach = 1 << (depth - local - 1)
            pointers[(2 * prefix + 1) * reach : (2 * prefix + 2) * reach] = len(buckets) - 1
            full += [at, len(buckets) - 1]
        order = sorted(range(len(buckets)), key=lambda b: buckets[b][0] << (bits - buckets[b][1]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(depth, place[pointers], [buckets[b] for b in order])

    def owner(self, keys: np.ndarray) -> np.ndarray:
        """The bucket of each unsigned 64-bit key."""
        if not self.depth:
            return np.zeros(len(keys), np.int64)
        return self.pointers[(keys >> np.uint64(64 - self.depth)).astype(np.int64)]


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", F.xxhash64(whole_text())).withColumn("_sha", F.sha2(whole_text(), 256))


def directory(docs: DataFrame, capacity: int = BUCKET_ROWS, depth: int = DEPTH) -> Directory:
    """Grow the directory for the distinct keys of ``docs``."""
    prefix = F.shiftrightunsigned(F.col("_key"), 64 - depth)
    cells = docs.select(F.xxhash64(whole_text()).alias("_key")).distinct().groupBy(prefix.alias("cell")).count()
    histogram = np.zeros(1 << depth, np.int64)
    for cell, count in cells.collect():  # at most 2^depth
        histogram[cell] = count
    return Directory.grown(histogram, capacity)


_TEXTS = "bucket long, key long, text string, keep_id long, group_size long"
_INDEX = "bucket long, key long, chain int, text_sha256 string, keep_id long, group_size long"


def _equal_texts(part: pa.Table) -> pa.Table:
    """One row per bucket, key and text; texts are compared as bytes."""
    out = part.group_by(["bucket", "key", "text"]).aggregate([("keep_id", "max"), ("group_size", "sum")])
    out = out.rename_columns([c.removesuffix("_max").removesuffix("_sum") for c in out.column_names])
    return out.select(["bucket", "key", "text", "keep_id", "group_size"])


def _combined(grown: Directory):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, GATHERED):
            rows = pa.table(
                {
                    "bucket": grown.owner(part["_key"].to_numpy().view(np.uint64)),
                    "key": part["_key"],
                    "text": part["text"].cast(pa.large_string()),
                    "keep_id": part["doc_id"],
                    "group_size": np.ones(part.num_rows, np.int64),
                }
            )
            out = _equal_texts(rows)
            yield from out.set_column(2, "text", out["text"].cast(pa.string())).to_batches()

    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of an owner's texts, which come in key order."""

    def rows(part: pa.Table) -> pa.RecordBatch:
        shas = [hashlib.sha256(x.as_buffer()).hexdigest() for x in part["text"].combine_chunks()]
        keys = part["key"].to_numpy()
        order = np.lexsort((shas, keys))
        new = np.r_[True, keys[order][1:] != keys[order][:-1]]
        at = np.arange(len(order))
        chain = np.empty(len(order), np.int32)
        chain[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        cols = [part["bucket"], part["key"], pa.array(chain), pa.array(shas), part["keep_id"], part["group_size"]]
        flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]
        return pa.RecordBatch.from_arrays(flat, ["bucket", "key", "chain", "text_sha256", "keep_id", "group_size"])

    held = None  # the texts of the last key, which may go on in the next batch
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = part.set_column(part.schema.get_field_index("text"), "text", part["text"].cast(pa.large_string()))
        part = _equal_texts(part if held is None else pa.concat_tables([held, part]))
        last = pc.equal(part["key"], batch.column("key")[-1])
        held = part.filter(last)
        done = part.filter(pc.invert(last))
        if done.num_rows:
            yield rows(done)
    if held is not None:
        yield rows(held)


def build_index(docs: DataFrame, capacity: int = BUCKET_ROWS) -> DataFrame:
    """The index of all texts, on shared files: one row per distinct text.

    ``bucket``, ``key``, ``chain`` (0, 1, ... among different texts of one key), ``text_sha256``, ``keep_id`` (the largest
    doc_id; null only if no row has one) and ``group_size`` (rows with the text). Copies are combined per task before they
    are shuffled, so a text that fills a third of all rows reaches its owner about once per task.
    """
    grown = directory(docs, capacity)
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.xxhash64(whole_text()).alias("_key")
    )
    texts = given.mapInArrow(lean(_combined(grown)), _TEXTS)
    # Signed keys order like unsigned ones within a bucket, unless the bucket holds both halves; equal keys meet anyway.
    owners = texts.repartition("bucket").sortWithinPartitions("bucket", "key")
    return stored(owners.mapInArrow(lean(_chained), _INDEX), "exact-index")


def mark(docs: DataFrame, capacity: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``: one row per row given.

    Texts are equal when their bytes are; null counts as empty. The row with the largest ``doc_id`` is kept, and a null id
    is below all others. Of rows that repeat both id and text, one is kept. Empty input gives no rows.
    """
    docs = without(docs, *OUTPUTS)
    index = build_index(docs, capacity)
    total = index.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    found = index.select(
        F.col("key").alias("_key"), F.col("text_sha256").alias("_sha"), "keep_id", "group_size", F.col("group_size").alias("_rows")
    )
    joined = lookup(_hashed(docs), found, ["_key", "_sha"], "_rows", total)
    again = Window.partitionBy("_key", "_sha", "doc_id").orderBy(F.lit(0))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(again) == 1)
    return joined.withColumn("kept", stays).withColumn("text_sha256", F.col("_sha")).drop("_key", "_sha")


def deduplicate(docs: DataFrame, capacity: int = BUCKET_ROWS) -> DataFrame:
    """The kept rows of ``mark``, with the columns given."""
    return mark(docs, capacity).where("kept").select(*docs.columns)


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return mark(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")

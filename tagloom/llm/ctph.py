"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over 7 bytes decides where chunks end: wherever hash + 1 is a multiple of the block size (3 * 2^k). Each chunk
gives one of 64 characters. The block size is the least for which a text has fewer than CHUNKS chunk ends, made smaller again
while there are fewer than a quarter of that; the last character of a signature stands for all that is left. The fingerprint
holds the signatures at that size, at twice and at four times it, so that texts of unlike length still meet. Two fingerprints
are compared at the block sizes they share, by the edit distance (insertions and deletions) of their signatures.

All of it is computed for the whole text at once in numpy: the rolling hash as a sum of shifted bytes, the chunk hashes as
differences of one running polynomial sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tagloom.llm.common import id_bounds, range_of, shuffle_partitions, whole_text, without

WINDOW = 7
SMALLEST = 3
CHUNKS = 64
LEVELS = 3
#: Block sizes go up to 3 * 2^LARGEST; a text with more chunk ends even there has its last chunks hashed as one.
LARGEST = 40
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: A run of so many equal characters must be shared, or a quarter of a short signature, else the likeness is 0.
COMMON = 7

_FACTOR = np.uint64(0x5851F42D4C957F2D)  # odd
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Powers:
    """Powers of a factor modulo 2^64, extended as texts need them."""

    def __init__(self, factor: np.uint64):
        self.factor, self.table = factor, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            steps = np.full(max(n, 1 << 16), self.factor, np.uint64)
            steps[0] = 1
            self.table = np.cumprod(steps)
        return self.table[:n]


_UP, _DOWN = _Powers(_FACTOR), _Powers(_INVERSE)
_WEIGHTS = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(WINDOW)]


def _ends(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a chunk may end, and the largest k for which the block size 3 * 2^k ends one there."""
    rolling = np.zeros(len(data), np.uint64)
    wide = data.astype(np.uint64)
    for k, weight in enumerate(_WEIGHTS):
        if k < len(data):
            rolling[k:] += wide[: len(data) - k] * weight
    rolling ^= rolling >> np.uint64(29)
    rolling *= _MIX
    rolling >>= np.uint64(16)  # 48 bits that depend on all bytes of the window
    places = np.flatnonzero(rolling % np.uint64(SMALLEST) == SMALLEST - 1)
    next_ = (rolling[places] + np.uint64(1)) // np.uint64(SMALLEST)
    lowest = next_ & (np.uint64(0) - next_)
    return places, np.log2(lowest.astype(float)).astype(np.int64)


def _signature(sums: np.ndarray, places: np.ndarray) -> str:
    """A character for each chunk that ends at ``places`` and for what is left at the end."""
    n = len(sums) - 1
    stops = places + 1
    if not len(stops) or stops[-1] < n:
        stops = np.r_[stops, n]
    starts = np.r_[0, stops[:-1]]
    hashes = (sums[stops] - sums[starts]) * _DOWN.upto(n + 1)[starts]
    hashes ^= hashes >> np.uint64(32)
    return "".join(ALPHABET[i] for i in (hashes * _MIX >> np.uint64(58)).tolist())


def fingerprint(text: str) -> str:
    """``block size:signature:signature at twice the size:at four times`` of a text; the empty text has ``3:::``."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return f"{SMALLEST}" + ":" * LEVELS
    places, level = _ends(data)
    many = np.bincount(level, minlength=LARGEST + 1)[::-1].cumsum()[::-1]  # chunk ends from each level up
    k = min(int((many >= CHUNKS).sum()), LARGEST)
    while k and many[k] < CHUNKS // 4:
        k -= 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP.upto(len(data)), out=sums[1:])
    signatures = [_signature(sums, places[level >= k + j][: CHUNKS - 1]) for j in range(LEVELS)]
    return f"{SMALLEST << k}:" + ":".join(signatures)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one number."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & every
    return len(a) - row.bit_count()


def _share_run(a: str, b: str, run: int) -> bool:
    known = {a[i : i + run] for i in range(len(a) - run + 1)}
    return any(b[i : i + run] in known for i in range(len(b) - run + 1))


def likeness(one: str, other: str) -> float:
    """0 to 1: the best likeness at a block size that both fingerprints have; 1 for equal fingerprints.

    At one block size it is 1 less the edit distance over the summed lengths, and 0 without a common run of characters.
    """
    if one == other:
        return 1.0
    size1, *first = one.split(":")
    size2, *second = other.split(":")
    have = {int(size1) << j: s for j, s in enumerate(first)}
    best = 0.0
    for j, b in enumerate(second):
        a = have.get(int(size2) << j, "")
        if a and b and _share_run(a, b, min(COMMON, max(1, min(len(a), len(b)) // 4))):
            best = max(best, 2 * common_subsequence(a, b) / (len(a) + len(b)))
    return best


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many characters from the start of the following text (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint`` of its whole text (null: empty). Extra columns pass; rows repeat as given."""
    docs = without(docs, "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py() or "") for x in batch.column("text")]
            yield batch.append_column("fingerprint", pa.array(found, pa.string()))

    typed = docs.withColumn("text", F.col("text").cast("string"))
    return typed.mapInArrow(run, StructType([*typed.schema.fields]).add("fingerprint", StringType()))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with the next; rows come in order, and ``own`` is false for those that are only here to be the next."""
    held = None  # range, own, id, text, fingerprint
    out: list[tuple] = []

    def pair(row: tuple, nxt: tuple) -> tuple:
        _, _, doc_id, text, print_ = row
        changed = edited(text, nxt[3])
        changed_print = fingerprint(changed)
        sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), sha, print_, changed_print, likeness(print_, changed_print), likeness(print_, nxt[4])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for part, own, doc_id, text in zip(*(batch.column(c) for c in ("part", "own", "doc_id", "text")), strict=True):
            text = text.as_py()
            row = (part.as_py(), own.as_py(), doc_id.as_py(), text, fingerprint(text))
            if held is not None and held[1] and held[0] == row[0]:
                out.append(pair(held, row))
                if len(out) == 1000:
                    yield table(out)
                    out = []
            held = row
    if out:
        yield table(out)


def compare_next(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness to each other and to the next document.

    Columns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.
    The next is that of the next larger id (null ids first; equal ids by text), after the last the first; a single document is
    its own next. Null text is empty. The ids are cut into ranges, and the row after a range's last is also sent to that range,
    so no task sees more than its range. Empty input gives no rows.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    bounds = id_bounds(given, "doc_id", shuffle_partitions(docs.sparkSession))
    # The first row of all follows the last; range_of gives the last range the number of bounds.
    ends = given.agg(F.min("doc_id"), F.count("*"), F.count("doc_id")).first()
    least, rows, known = ends
    if not rows:
        return given.where(F.lit(False)).mapInArrow(_compared_none, _OUT)
    start = F.col("doc_id").isNull() if known < rows else F.col("doc_id") == F.lit(least)
    part = range_of(F.col("doc_id"), bounds)
    # own, range before (for a row with an id that begins a range), the last range (for the first row)
    copies = F.filter(
        F.array(
            F.struct(part.alias("part"), F.lit(True).alias("own"), F.lit(0).alias("last")),
            F.when(F.col("doc_id").isin(bounds), F.struct((part - 1).alias("part"), F.lit(False).alias("own"), F.lit(0).alias("last"))),
            F.when(start, F.struct(F.lit(len(bounds)).alias("part"), F.lit(False).alias("own"), F.lit(1).alias("last"))),
        ),
        lambda x: x.isNotNull(),
    )
    dealt = given.withColumn("c", F.explode(copies)).select("c.part", "c.own", "c.last", "doc_id", "text")
    ordered = dealt.repartition("part").sortWithinPartitions("part", "last", F.col("doc_id").asc_nulls_first(), "text")
    return ordered.select("part", "own", "doc_id", "text").mapInArrow(_compared, _OUT)


def _compared_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from ()


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

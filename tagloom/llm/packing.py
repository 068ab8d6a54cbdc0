"""Packing documents into sequences by cutting-stock column generation.

A text's ids are cut into whole sequences and one rest shorter than a sequence. The rests' lengths, rounded up to GRAIN, form a
histogram: the demand of a cutting-stock problem. A pattern says how many rests of each class share a sequence. A linear
program over patterns is solved by column generation (the duals smoothed with the best so far), a knapsack dynamic program
finding the pattern of the best price in each round. Patterns are rounded down, what they leave is packed best-fit, and the
documents, ranked within their class, take the places of the patterns in order.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.llm import tokens
from tagloom.llm.common import lean, shuffle_partitions, stored

LENGTH = 1024
END_ID = 0
#: Rests are told apart to so many ids: finer grains leave less padding and take more rounds. At 8 it stays below 1 % of the rests.
GRAIN = 8
#: The linear program ends when its value is within this share of its lower bound, or after so many columns.
GAP, COLUMNS = 1e-4, 4000


def best_pattern(value: np.ndarray, lengths: np.ndarray, top: int) -> tuple[float, np.ndarray]:
    """The pattern of the largest total value that fits into ``top``; ``value`` belongs to ``lengths``, which ascend."""
    worth = np.full(top + 1, -np.inf)
    worth[lengths] = value
    best, last = np.zeros(top + 1), np.zeros(top + 1, np.int64)
    back = best[::-1]
    for total in range(1, top + 1):
        some = back[top - total + 1 : top + 1] + worth[1 : total + 1]
        k = int(some.argmax())
        best[total], last[total] = max((some[k], k + 1), (best[total - 1], 0))  # 0: one place stays empty
    pattern = np.zeros(top + 1, np.int64)
    at = top
    while at:
        pattern[last[at]] += 1
        at -= last[at] or 1
    return float(best[top]), pattern[lengths]


def cutting_stock(demand: np.ndarray, gap: float = GAP, columns: int = COLUMNS) -> list[tuple[int, np.ndarray]]:
    """Patterns for the demand by length (place 0 unused, the last is a whole sequence): (times, places per length).

    Every rest gets exactly one place. A revised simplex method; memory and work depend on the number of lengths alone, and
    what rounding leaves for best-fit is at most a sequence for each pattern.
    """
    top = len(demand) - 1
    lengths = np.flatnonzero(demand)
    m = len(lengths)
    if not m:
        return []
    need = demand[lengths].astype(float)
    fits = top // lengths  # each length alone, as often as it fits, to begin with
    patterns, inverse, x = np.diag(fits), np.diag(1.0 / fits), need / fits
    centre, bound = lengths / top, 0.0
    for _ in range(columns):
        dual = inverse.sum(axis=0)  # every pattern costs one sequence
        for trial in (0.7 * centre + 0.3 * dual, dual):
            worth, column = best_pattern(trial, lengths, top)
            feasible = trial / max(worth, 1.0)
            if float(feasible @ need) > bound:
                centre, bound = feasible, float(feasible @ need)
            if float(dual @ column) > 1 + 1e-9:
                break
        else:
            break  # no pattern improves
        if x.sum() * (1 - gap) <= bound:
            break
        way = inverse @ column
        up = np.flatnonzero(way > 1e-9)
        step = x[up] / way[up]
        r = up[int(step.argmin())]
        theta = x[r] / way[r]
        x = np.maximum(x - theta * way, 0.0)
        x[r] = theta
        row = inverse[r] / way[r]
        way[r] = 0.0
        inverse -= np.outer(way, row)
        inverse[r], patterns[r] = row, column
    times = np.floor(x + 1e-9).astype(np.int64)
    left = demand[lengths] - times @ patterns
    while (left < 0).any():  # what floating point rounded up
        r = int(np.flatnonzero((times > 0) & (patterns[:, left.argmin()] > 0))[0])
        times[r] -= 1
        left = left + patterns[r]
    out = [(int(t), p) for t, p in zip(times, patterns, strict=True) if t]
    # Longest first, into the fullest sequence that takes it.
    bins: list[np.ndarray] = []
    room: list[tuple[int, int]] = []
    for k in range(m - 1, -1, -1):
        for _ in range(int(left[k])):
            at = bisect_left(room, (int(lengths[k]), -1))
            if at == len(room):
                bins.append(np.zeros(m, np.int64))
                free, which = top, len(bins) - 1
            else:
                free, which = room.pop(at)
            bins[which][k] += 1
            insort(room, (free - int(lengths[k]), which))
    whole = np.zeros((len(out) + len(bins), top + 1), np.int64)
    whole[:, lengths] = np.array([p for _, p in out] + bins)
    return list(zip([t for t, _ in out] + [1] * len(bins), whole, strict=True))


class Places:
    """Where the rest of a class and rank goes: a sequence, and its slot there."""

    def __init__(self, patterns: list[tuple[int, np.ndarray]]):
        rows, filled, sequence = [], {}, 0
        for times, pattern in patterns:
            slot = 0
            for k in np.flatnonzero(pattern)[::-1]:  # the longest first
                many = int(pattern[k])
                first = filled.get(k, 0)
                rows.append((int(k), first, many, sequence, slot))
                filled[k] = first + many * times
                slot += many
            sequence += times
        self.sequences = sequence
        rows.sort()
        self.kind, self.first, self.many, self.sequence, self.slot = np.array(rows or [(0, 0, 1, 0, 0)], np.int64).T

    def find(self, kind: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.kind << 48 | self.first, kind << 48 | rank, "right") - 1
        on = rank - self.first[at]
        return self.sequence[at] + on // self.many[at], self.slot[at] + on % self.many[at]


_PLACED = "key long, rest long, rest_sequence long, slot long, whole_sequence long"


def _placed(places: Places, ranks: dict[int, np.ndarray], wholes: dict[int, int]):
    """Ranks within class and bucket, continued from the buckets before, and the places they give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rank, whole = None, None, 0
        for batch in batches:
            bucket, key, n, rest, kind = (batch.column(c).to_numpy() for c in ("bucket", "key", "n_whole", "rest", "kind"))
            edges = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if bucket[lo] != now:
                    now = int(bucket[lo])
                    rank, whole = ranks[now].copy(), wholes[now]
                k = kind[lo:hi]
                order = np.argsort(k, kind="stable")
                runs = np.flatnonzero(np.r_[True, k[order][1:] != k[order][:-1]])
                within = np.empty(hi - lo, np.int64)
                within[order] = np.arange(hi - lo) - np.repeat(runs, np.diff(np.r_[runs, hi - lo]))
                sequence, slot = places.find(k, rank[k] + within)
                none = rest[lo:hi] == 0
                sequence[none] = -1 - key[lo:hi][none]  # keeps rows without a rest apart
                slot[none] = 0
                after = whole + np.cumsum(n[lo:hi])
                cols = [key[lo:hi], rest[lo:hi], sequence, slot, after - n[lo:hi]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "rest", "rest_sequence", "slot", "whole_sequence"])
                rank += np.bincount(k, minlength=len(rank))
                whole = int(after[-1])

    return run


_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pieces(size: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):  # bounds what one Arrow batch holds
                batch = whole.slice(lo, 2000)
                n, rest = batch.column("n_tokens").to_numpy(), batch.column("rest").to_numpy()
                ids = tokens.as_ids(batch.column("ids"), size).astype("<u4")
                count = -(-n // length)
                row = np.repeat(np.arange(len(n)), count)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                is_rest = (nth == count[row] - 1) & (rest[row] > 0)
                long = np.where(is_rest, rest[row], length)
                first, sequence, at = (batch.column(c).to_numpy()[row] for c in ("whole_sequence", "rest_sequence", "rest_offset"))
                offsets = (4 * np.r_[0, np.cumsum(long)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row)),
                        pa.array(nth * length),
                        pa.array(long),
                        pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                        pa.array(n[row]),
                        pa.array(np.where(is_rest, sequence, first + nth)),
                        pa.array(np.where(is_rest, at, 0)),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    return run


def pack(docs: DataFrame, length: int = LENGTH, end: int = END_ID, grain: int = GRAIN, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of its text before it), ``length``, ``ids`` (little-endian u32),
    ``doc_tokens`` (with the closing id), ``sequence_id`` and ``offset`` in the sequence.

    Every row of ``docs`` is a document of its own, whether its id repeats or is null; a null text is empty and still has its
    closing id. ``length`` is a multiple of ``grain``. The driver holds a histogram of lengths per bucket (as many buckets as
    shuffle partitions) and the patterns; what runs over documents is ranked in tasks, a class of any size being spread over
    all buckets. Empty input gives no rows.
    """
    if length % grain:
        raise ValueError("length must be a multiple of grain")
    tokenizer = tokenizer or tokens.default_path()
    size = tokens.width(tokenizer, end)
    # The number is made once, when the ids are written.
    ids = stored(tokens.tokenized(docs, end, tokenizer).withColumn("key", F.monotonically_increasing_id()), "ids", compression="zstd")
    buckets = shuffle_partitions(docs.sparkSession)
    rest = F.col("n_tokens") % length
    slim = ids.select(
        F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"),
        "key",
        F.floor(F.col("n_tokens") / length).cast("long").alias("n_whole"),
        rest.alias("rest"),
        F.ceil(rest / grain).cast("long").alias("kind"),
    )
    kinds = length // grain + 1
    counts = np.zeros((buckets, kinds), np.int64)
    whole = np.zeros(buckets, np.int64)
    for bucket, kind, n, full in slim.groupBy("bucket", "kind").agg(F.count("*"), F.sum("n_whole")).collect():
        counts[bucket, kind] = n
        whole[bucket] += full
    demand = counts.sum(axis=0)
    demand[0] = 0
    places = Places(cutting_stock(demand))
    ranks = dict(enumerate(np.cumsum(counts, axis=0) - counts))
    wholes = dict(enumerate((places.sequences + np.cumsum(whole) - whole).tolist()))
    dealt = slim.repartition("bucket").sortWithinPartitions("bucket", "key")
    placed = dealt.mapInArrow(_placed(places, ranks, wholes), _PLACED)
    before = Window.partitionBy("rest_sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("rest_offset", F.coalesce(F.sum("rest").over(before), F.lit(0)))
    together = ids.join(placed, "key").select("doc_id", "n_tokens", "ids", "rest", "whole_sequence", "rest_sequence", "rest_offset")
    return together.mapInArrow(lean(_pieces(size, length)), _PIECES)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

"""Near-duplicates by SimHash, compared bit-sliced.

A text's fingerprint has 64 bits, each the majority of that bit over the hashes of its word shingles.

Close fingerprints (64 bits, radius 3) agree in at least two of five bit blocks, so each pair of blocks gives a table of
buckets: ten tables, keys of 25 or 26 bits, and no pair is missed.

Within a bucket fingerprints are stored as bit planes, 64 to a word: one word operation advances 64 distances. Distances are
counted in carry-save counters, a few planes and an overflow, and a word whose distances have all overflowed is abandoned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tagloom.llm.common import lookup, stored, unused, whole_text
from tagloom.llm.components import components

WORDS = 3
RADIUS = 3
SEED = 42
#: First bit and width of each block.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
TABLES = list(combinations(range(5), 2))
#: Fingerprints of a bucket that one task compares; larger buckets are cut, and each pair of parts is a task's work.
PART = 4096
#: Words and shingles handled at a time within one text.
CHUNK = 1 << 16


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes set each bit."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _hashes(text: str, words: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of a text's word shingles, some at a time; none if it has no word."""
    data = text.encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only
    tokens = data.split()  # splits at 0x20 and 0x09-0x0D
    if not tokens:
        return
    shingles = max(1, len(tokens) - words + 1)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    del tokens
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(words, len(ends)) - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, shingles, CHUNK):
        pairs = zip(starts[at : min(at + CHUNK, shingles)].tolist(), last[at : at + CHUNK].tolist(), strict=True)
        yield np.array([digest(joined[s:e], seed) for s, e in pairs], np.uint64)


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """The SimHash of a text, as an unsigned number; 0 if it has no word."""
    ones, shingles = np.zeros(64, np.int64), 0
    for found in _hashes(text, words, seed):
        ones += _bits(found)
        shingles += len(found)
    return int(np.packbits(2 * ones > shingles, bitorder="little").view(np.uint64)[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), words) for x in batch.column("text")]
            cols = [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "f0"])

    return run


def _fingerprint_of(words: int) -> Callable[[Column], Column]:
    @F.pandas_udf(LongType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return run


def _given(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id`` and ``f0`` (64 bits, as a signed long) of every row; null text counts as empty."""
    return _given(docs).mapInArrow(_fingerprints(words), "doc_id long, f0 long")


def _within(fps: np.ndarray, runs: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint (a row of words) the place of the first one it is linked to in its run, directly or over others.

    ``runs`` ascends and says which rows are compared with each other.
    """
    n, wide = fps.shape
    begin = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
    length = np.diff(np.r_[begin, n])
    width = (length + 63) // 64
    first_word = np.r_[0, np.cumsum(width)]
    run = np.repeat(np.arange(len(begin)), length)
    place = np.arange(n) - begin[run]
    word, lane = first_word[run] + place // 64, (place % 64).astype(np.uint64)
    starts_word = np.flatnonzero(place % 64 == 0)  # rows come in order of their words
    one = np.uint64(1)
    planes = np.zeros((64 * wide, first_word[-1]), np.uint64)
    for bit in range(64 * wide):
        planes[bit] = np.bitwise_or.reduceat(((fps[:, bit // 64] >> np.uint64(bit % 64)) & one) << lane, starts_word)
    lanes = np.bitwise_or.reduceat(one << lane, starts_word)
    label = np.arange(n)
    # A row meets the words of its run from its own on.
    todo = width[run] - place // 64
    cut = np.r_[0, np.cumsum(todo)]
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(cut, cut[row] + (1 << 14), "right")) - 1)
        asks = np.repeat(np.arange(row, stop), todo[row:stop])
        at = word[asks] + np.arange(len(asks)) - (cut[asks] - cut[row])
        row = stop
        counter = [np.zeros(len(asks), np.uint64) for _ in range(radius.bit_length())]
        over = np.zeros(len(asks), np.uint64)
        for bit in range(64 * wide):
            carry = planes[bit][at] ^ (np.uint64(0) - ((fps[asks, bit // 64] >> np.uint64(bit % 64)) & one))
            for plane in counter:  # in place: one more for every lane that differs
                both = plane & carry
                plane ^= carry
                carry = both
            over |= carry
            if bit % 16 == 15:
                alive = (~over & lanes[at]) != 0
                if not alive.all():
                    asks, at, over = asks[alive], at[alive], over[alive]
                    counter = [x[alive] for x in counter]
                    if not len(asks):
                        break
        same = ~np.zeros(len(asks), np.uint64)  # lanes whose count agrees with the radius so far, from the highest bit down
        for k in range(len(counter) - 1, -1, -1):
            if radius >> k & 1:
                same &= counter[k]
            else:
                over |= same & counter[k]
                same &= ~counter[k]
        hit = ~over & lanes[at]
        some = hit != 0
        found = np.unpackbits(hit[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        a, b = np.nonzero(found)
        u, v = asks[some][a], starts_word[at[some][a]] + b
        keep = u < v
        u, v = u[keep], v[keep]
        label = _joined(label, u, v)
    return label


def _joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    u, v = label[u], label[v]
    while len(u):
        np.minimum.at(label, v, label[u])
        np.minimum.at(label, u, label[v])
        while (label[label] != label).any():
            label = label[label]
        apart = label[u] != label[v]
        u, v = label[u[apart]], label[v[apart]]
    return label


def _linked(wide: int, radius: int):
    """Links of the buckets, which come whole and in order; each fingerprint gives at most one link in each."""
    names = ["t", "k", "p", "node", *(f"f{i}" for i in range(wide))]

    def links(part: dict[str, np.ndarray]) -> pa.RecordBatch:
        new = [part[c][1:] != part[c][:-1] for c in ("t", "k", "p")]
        runs = np.cumsum(np.r_[False, new[0] | new[1] | new[2]])
        label = _within(np.stack([part[f"f{i}"].view(np.uint64) for i in range(wide)], axis=1), runs, radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(part["node"][moved]), pa.array(part["node"][label[moved]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: np.zeros(0, np.int64) for c in names}
        for batch in batches:
            part = {c: np.concatenate([held[c], batch.column(c).to_numpy(zero_copy_only=False)]) for c in names}
            last = np.ones(len(part["t"]), bool)
            for c in ("t", "k", "p"):
                last &= part[c] == part[c][-1]
            cut = int(last.argmax())  # the last bucket may go on in the next batch
            held = {c: v[cut:] for c, v in part.items()}
            if cut:
                yield links({c: v[:cut] for c, v in part.items()})
        if len(held["t"]):
            yield links(held)

    return run


def _block_keys(nodes: DataFrame) -> DataFrame:
    """A row for each fingerprint and table, keyed by a pair of its blocks."""
    keys = []
    for number, (x, y) in enumerate(TABLES):
        (s1, w1), (s2, w2) = BLOCKS[x], BLOCKS[y]
        high = F.shiftrightunsigned("f0", s1).bitwiseAND((1 << w1) - 1)
        low = F.shiftrightunsigned("f0", s2).bitwiseAND((1 << w2) - 1)
        keys.append(F.struct(F.lit(number).cast("long").alias("t"), (high * (1 << w2) + low).alias("k")))
    return nodes.select("node", "f0", F.explode(F.array(*keys)).alias("s")).select("s.t", "s.k", "node", "f0")


def links(rows: DataFrame, wide: int, radius: int) -> DataFrame:
    """Links ``a``, ``b`` (nodes) that span every group of fingerprints of one bucket within ``radius`` of each other.

    ``rows`` has ``t``, ``k``, ``node``, ``f0``, ... A bucket of more than PART fingerprints is cut, and every pair of its parts
    is compared, so no bucket is one task's work and none is capped.
    """
    names = [f"f{i}" for i in range(wide)]
    dealt = _dealt(rows, ["t", "k"], ["node", *names], PART)
    ordered = dealt.repartition("t", "k", "p").sortWithinPartitions("t", "k", "p", *names)
    return ordered.mapInArrow(_linked(wide, radius), "a long, b long")


def _dealt(rows: DataFrame, keys: list[str], names: list[str], part: int) -> DataFrame:
    """``keys``, ``p`` and ``names``: each group of more than one row, once for each pair of its parts that a row is of."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / part)
    own = F.pmod(F.xxhash64("node"), parts)
    met = F.when(parts == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0).cast("long"), parts - 1), lambda o: o != own),
            lambda o: F.least(o, own) * parts + F.greatest(o, own),
        )
    )
    return rows.join(sizes, keys).select(*keys, F.explode(met).alias("p"), *names)


def _grouped(rows: DataFrame, nodes: DataFrame, found_links: DataFrame) -> DataFrame:
    """``rows`` with ``component_id``, the least doc_id that can be reached; ``nodes`` has their ``node``, ``first_id``, ``rows``."""
    roots = components(found_links).select(F.col("a").alias("node"), "root")
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    count, total = nodes.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    found = lookup(placed.select("node", "root", "rows"), least, ["root"], "members", count).drop("root")
    return lookup(rows, found, ["node"], "rows", total)


def mark(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row, by close fingerprints.

    ``component_id`` is the least doc_id that can be reached over links of at most ``radius`` (3 or less) differing bits, the
    row's own included. Texts without a word have fingerprint zero and are linked like any other; null text counts as empty.
    Rows with a null id take part; a group without any id has a null component. Empty input gives no rows.
    """
    if not 0 <= radius <= 3:
        raise ValueError("five blocks find pairs of at most 3 differing bits")
    fps = stored(fingerprints(docs, words).withColumn("node", F.col("f0")), "simhash")
    found = _components_of(fps, radius)
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def _components_of(fps: DataFrame, radius: int) -> DataFrame:
    """``fps`` (``doc_id``, ``f0`` and the same as ``node``) with ``component_id``."""
    nodes = fps.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"))
    nodes = stored(nodes.withColumn("f0", F.col("node")), "simhash-nodes")
    return _grouped(fps, nodes, links(_block_keys(nodes), 1, radius))


def deduplicate(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each component of ``mark``, the one with the least id, with the columns given.

    Rows that share an id and a fingerprint are one document; a component without any id keeps all its rows. Texts without a word
    are one component. The documents are kept in the shared folder beside their fingerprints, which are computed once.
    """
    own = unused(docs, "fingerprint_of")
    held = stored(docs.withColumn(own, _fingerprint_of(words)(whole_text())), "simhash-docs")
    ids = held.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(own).alias("f0"), F.col(own).alias("node"))
    found = _components_of(ids, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.select(F.col("doc_id").alias("_kept"), F.col("f0").alias("_print")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")) & (F.col(own) == F.col("_print"))
    return held.join(kept, same, "left_semi").drop(own)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    return mark(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

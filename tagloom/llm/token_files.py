"""Token ids in files: frequency-ranked, byte-aligned variable length, control bytes apart.

Ids are replaced by their rank in the corpus, so that the commonest 256 take one byte and the next 65,280 two. A control byte
holds the lengths of four numbers; control bytes and number bytes are separate streams. Decoding looks the four lengths up in
a table of 256 rows and gathers whole blocks at once.

A folder holds ``ranks`` (``rank``, ``id``) and ``blocks``, Parquet rows that each carry one self-contained binary block:
consecutive documents in ascending doc_id order (nulls first). A block's bytes are a header (magic, documents, ids, control
bytes; little-endian u32, u32, u64, u64), then doc_ids (i64), flags of ids that are null (u8), ids per document (u64), control
bytes and number bytes. Within ``part`` the rows of a file go on in order; ``part`` ascends with doc_id.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import tokens
from tagloom.llm.common import id_bounds, range_of, shuffle_partitions, stored
from tagloom.session import scratch_dir

MAGIC = 0x31565354
HEADER = "<IIQQ"
#: Ids after which a block is closed.
BLOCK_IDS = 1 << 20
END_ID = 2

#: Lengths of the four numbers of each control byte.
LENGTHS = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3)


def pack(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and number bytes of several sequences, each with the bytes per sequence.

    Every sequence begins a control byte; unused places in its last one are 0.
    """
    values = values.astype(np.uint32, copy=False)
    size = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)
    controls = (counts + 3) // 4
    first = np.cumsum(counts) - counts
    place = np.arange(len(values)) + np.repeat(4 * (np.cumsum(controls) - controls) - first, counts)
    codes = np.zeros(4 * int(controls.sum()), np.uint8)
    codes[place] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    at = np.cumsum(size) - size
    data = np.empty(int(size.sum()), np.uint8)
    data[at] = values & 0xFF
    for k in (1, 2, 3):
        some = np.flatnonzero(size > k)
        if len(some):
            data[at[some] + k] = values[some] >> np.uint32(8 * k) & 0xFF
    stops = np.concatenate([[0], np.cumsum(size)])
    return control, data, controls, stops[first + counts] - stops[first]


def unpack(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers that ``pack`` was given."""
    controls = (counts + 3) // 4
    first = np.cumsum(counts) - counts
    place = np.arange(int(counts.sum())) + np.repeat(4 * (np.cumsum(controls) - controls) - first, counts)
    size = LENGTHS[control].ravel()[place]
    at = np.cumsum(size) - size
    values = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        some = np.flatnonzero(size > k)
        if len(some):
            values[some] |= data[at[some] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _counted(size: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(tokens.as_ids(batch.column("ids"), size), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return run


def _ranked(size: int, rank: np.ndarray):
    """Documents with their ids in packed form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("n_tokens").to_numpy()
            ids = tokens.as_ids(batch.column("ids"), size)
            control, data, controls, sizes = pack(rank[ids], counts)
            cols = [batch.column("part"), batch.column("doc_id"), batch.column("n_tokens")]
            cols += [_binary(control, controls), _binary(data, sizes)]
            yield pa.RecordBatch.from_arrays(cols, ["part", "doc_id", "n_tokens", "control", "data"])

    return run


_BLOCKS = "part int, block long, start long, n_docs long, n_tokens long, payload binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents that come in order of part and doc_id; ``start`` counts the ids of the part before the block."""
    part, number, start = None, 0, 0
    docs: list[tuple] = []
    held = 0

    def closed() -> pa.RecordBatch:
        nonlocal docs, held, number, start
        ids = np.array([d[0] or 0 for d in docs], "<i8")
        null = np.array([d[0] is None for d in docs], np.uint8)
        counts = np.array([d[1] for d in docs], "<u8")
        control = b"".join(d[2] for d in docs)
        head = struct.pack(HEADER, MAGIC, len(docs), held, len(control))
        payload = b"".join([head, ids.tobytes(), null.tobytes(), counts.tobytes(), control, *(d[3] for d in docs)])
        row = {"part": [part], "block": [number], "start": [start], "n_docs": [len(docs)], "n_tokens": [held], "payload": [payload]}
        docs, number, start, held = [], number + 1, start + held, 0
        return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), *((n, pa.int64()) for n in ("block", "start", "n_docs", "n_tokens")), ("payload", pa.binary())]))

    for batch in batches:
        for p, *doc in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "control", "data")), strict=True):
            if docs and (p != part or held >= BLOCK_IDS):
                yield closed()
            if p != part:
                part, number, start = p, 0, 0
            docs.append(tuple(doc))
            held += doc[1]
    if docs:
        yield closed()


def write(docs: DataFrame, path: str, end: int = END_ID, tokenizer: str | None = None) -> None:
    """Encode every text (null: empty), close it with ``end``, and write the files to the new folder ``path``.

    Rows with equal ids stand in order of their length and bytes. The driver holds the counts of the vocabulary only. Texts are
    encoded once: their ids are kept in the shared folder between counting and writing. An empty table gives empty files.
    """
    tokenizer = tokenizer or tokens.default_path()
    spark = docs.sparkSession
    size = tokens.width(tokenizer, end)
    ids = stored(tokens.tokenized(docs, end, tokenizer), "ids", compression="zstd")
    vocabulary = max(tokens.encoder(tokenizer).size, end + 1)
    counts = ids.mapInArrow(_counted(size, vocabulary), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    order = sorted((-n, i) for i, n in counts.collect())  # at most the vocabulary
    rank = np.zeros(vocabulary, np.uint32)
    rank[[i for _, i in order]] = np.arange(len(order))
    spark.createDataFrame([(r, i) for r, (_, i) in enumerate(order)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    bounds = id_bounds(ids, "doc_id", shuffle_partitions(spark))
    placed = ids.withColumn("part", range_of(F.col("doc_id"), bounds).cast("int"))
    ranked = placed.mapInArrow(_ranked(size, rank), "part int, doc_id long, n_tokens long, control binary, data binary")
    ordered = ranked.repartition("part").sortWithinPartitions("part", "doc_id", "n_tokens", "control", "data")
    ordered.mapInArrow(_blocks, _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def _read(ids_of: np.ndarray, base: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, payload in zip(*(batch.column(c) for c in ("part", "start", "payload")), strict=True):
                raw = np.frombuffer(payload.as_buffer(), np.uint8)
                magic, n, total, controls = struct.unpack(HEADER, raw[: struct.calcsize(HEADER)])
                if magic != MAGIC:
                    raise ValueError("not a block of token ids")
                at = np.cumsum([struct.calcsize(HEADER), 8 * n, n, 8 * n, controls])
                doc_id = np.frombuffer(raw[at[0] : at[1]], "<i8")
                null = raw[at[1] : at[2]].astype(bool)
                counts = np.frombuffer(raw[at[2] : at[3]], "<u8").astype(np.int64)
                ids = ids_of[unpack(raw[at[3] : at[4]], raw[at[4] :], counts)].astype("<u4")
                begin = np.cumsum(counts) - counts
                for lo in range(0, n, 1000):  # bounds what one Arrow batch holds
                    hi = min(n, lo + 1000)
                    flat = ids[begin[lo] : begin[hi - 1] + counts[hi - 1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_id[lo:hi], pa.int64(), mask=null[lo:hi]),
                            pa.array(base[part.as_py()] + start.as_py() + begin[lo:hi]),
                            pa.array(counts[lo:hi]),
                            _binary(flat.view(np.uint8), 4 * counts[lo:hi]),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return run


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian u32) from the files."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_tokens")).collect())  # a row for each part
    base, before = {}, 0
    for part, total in totals:
        base[part] = before
        before += total
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").collect()  # the vocabulary
    ids_of = np.zeros(max(1, len(ranks)), np.uint32)
    for rank, number in ranks:
        ids_of[rank] = number
    return blocks.select("part", "start", "payload").mapInArrow(_read(ids_of, base), "doc_id long, start long, n_tokens long, ids binary")


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

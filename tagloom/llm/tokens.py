"""Token ids of whole texts, by the tokenizers library, at the speed a corpus needs.

A single space or line break between two printing characters always begins a new pre-token of a byte-level BPE with the usual
pattern, and so does punctuation after a letter, so a text may be cut there without changing its ids. The pieces of a batch are told apart in C++ (Arrow's dictionary
encoding), the library encodes each distinct piece once, and the ids of the texts are gathered from these.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm.common import gathered, lean, whole_text

#: Text bytes handled at a time; a longer text is handled alone. A worker takes about twelve times this beside its rows.
SLICE = 6 << 20
#: Pieces whose ids are kept from one stretch of text for the next, and the most bytes such a piece has.
KEPT, KEPT_BYTES = 1 << 18, 32
#: Bytes of distinct pieces given to the library at a time, and pieces gathered at a time.
JOINED, GATHERED = 1 << 18, 1 << 18

_SPACE, _BREAK = 0x20, 0x0A


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cuts(data: np.ndarray) -> np.ndarray:
    """Where pieces may begin within UTF-8 bytes: at a lone space or line break with a printing character on both sides, and at
    ASCII punctuation (no apostrophe, which begins contractions) after an ASCII letter.

    Printing means ASCII 0x21-0x7E or U+00C0-U+00FF (lead byte 0xC3); around any other character nothing is cut.
    """
    if len(data) < 4:
        return np.zeros(0, np.int64)
    kind = _KINDS[data]
    at = np.flatnonzero((kind == 1) | (kind == 3))
    at = at[(at >= 2) & (at < len(data) - 1)]
    before, lead, after, own = data[at - 1], data[at - 2], data[at + 1], kind[at]
    space = (own == 1) & (_printing(before) | (before >= 0x80) & (lead == 0xC3)) & (_printing(after) | (after == 0xC3))
    return at[space | (own == 3) & (kind[at - 1] == 2)]


#: Of each byte: 1 a space or line break, 2 an ASCII letter, 3 ASCII punctuation but the apostrophe.
_KINDS = np.array(
    [1 if b in (_SPACE, _BREAK) else 2 if chr(b).isalpha() else 3 if 0x20 < b < 0x7F and not chr(b).isalnum() and b != 0x27 else 0 for b in range(128)]
    + [0] * 128,
    np.uint8,
)


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of several runs, one run after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _printing(x: np.ndarray) -> np.ndarray:
    return (x > 0x20) & (x < 0x7F)


class Encoder:
    """Encodes texts with one tokenizer."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        kind = self.library.pre_tokenizer
        # Only for this kind of pre-tokenizer are texts known to fall apart at the cuts.
        self.divisible = type(kind).__name__ == "ByteLevel" and kind.use_regex and not kind.add_prefix_space and self.library.normalizer is None
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        #: Strings that are one token wherever they stand: nothing is cut within them.
        self.added = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(added, key=len, reverse=True))) if added else None
        self.kept = (pa.array([], pa.large_binary()), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        self.size = max(vocabulary.values(), default=0) + 1
        self.bytes = np.zeros(self.size, np.int64)  # a byte-level token has one character for each byte
        for token, number in vocabulary.items():
            self.bytes[number] = len(token.encode()) if token in added else len(token)

    def _alone(self, texts: list[str]) -> list[np.ndarray]:
        done = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in done]

    def _distinct(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces one after the other, and their numbers.

        Pieces that begin and end as at a cut are encoded joined into long strings, and told apart by their bytes.
        """
        n = len(pieces)
        offsets = np.frombuffer(pieces.buffers()[1], np.int64, n + 1, pieces.offset * 8)
        data = np.frombuffer(pieces.buffers()[2], np.uint8)
        size = np.diff(offsets)
        joined = np.zeros(n, bool)
        if self.divisible:
            some = np.flatnonzero(size >= 2)
            s, e = offsets[some], offsets[some + 1]
            joined[some] = (
                ((data[s] == _SPACE) | (data[s] == _BREAK))
                & (_printing(data[s + 1]) | (data[s + 1] == 0xC3))
                & (_printing(data[e - 1]) | (data[e - 1] >= 0x80) & (data[e - 2] == 0xC3))
            )
        count = np.zeros(n, np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # pieces, their ids
        for some in np.array_split(np.flatnonzero(joined), max(1, int(size[joined].sum()) // JOINED)):
            if not len(some):
                continue
            text = b"".join([data[offsets[i] : offsets[i + 1]].tobytes() for i in some]).decode("utf-8")
            ids = self._alone([text])[0]
            stop = np.cumsum(self.bytes[ids])
            count[some] = np.diff(np.searchsorted(stop, np.cumsum(size[some]), "right"), prepend=0)
            assert stop[-1] == size[some].sum()
            parts.append((some, ids))
        rest = np.flatnonzero(~joined)
        for at in range(0, len(rest), 1000):
            some = rest[at : at + 1000]
            found = self._alone([data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8") for i in some])
            count[some] = [len(x) for x in found]
            parts.append((some, np.concatenate(found)))
        start = np.cumsum(count) - count
        flat = np.empty(count.sum(), np.uint32)
        for some, ids in parts:
            each = count[some]
            flat[np.repeat(start[some] - (np.cumsum(each) - each), each) + np.arange(len(ids))] = ids
        return flat, count

    def _remembered(self, pieces: pa.LargeBinaryArray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_distinct``; only pieces that were not kept are encoded. The commonest of these (by ``often``) are kept."""
        at = pc.index_in(pieces, value_set=self.kept[0]).fill_null(-1).to_numpy()
        new, old = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        fresh, fresh_length = self._distinct(pieces.take(pa.array(new)))
        length = np.empty(len(pieces), np.int64)
        length[new], length[old] = fresh_length, self.kept[2][at[old]]
        start = np.cumsum(length) - length
        flat = np.empty(length.sum(), np.uint32)
        flat[_places(start[new], fresh_length)] = fresh
        begin = np.cumsum(self.kept[2]) - self.kept[2]
        flat[_places(start[old], length[old])] = self.kept[1][_places(begin[at[old]], length[old])]
        size = pc.binary_length(pieces).to_numpy()
        some = np.flatnonzero(size <= KEPT_BYTES)
        if len(some) > KEPT:
            some = some[np.argpartition(-often[some], KEPT)[:KEPT]]
        self.kept = pieces.take(pa.array(some)), flat[_places(start[some], length[some])], length[some]
        return flat, length

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin (with the end as last)."""
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
        first, last = int(offsets[0]), int(offsets[-1])
        if last == first:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8, last - first, first)
        begin = offsets - first
        border = np.zeros(len(data) + 1, bool)
        if self.divisible:
            border[cuts(data)] = True
            for found in self.added.finditer(data) if self.added else ():
                border[found.start() + 1 : found.end()] = False
        border[begin] = True
        places = np.flatnonzero(border)
        del border
        array = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
        array = array.dictionary_encode()
        of = array.indices.to_numpy()
        flat, length = self._remembered(array.dictionary, np.bincount(of, minlength=len(array.dictionary)))
        start = np.cumsum(length) - length
        ends = np.concatenate([[0], np.cumsum(length[of])])
        ids = np.empty(ends[-1], np.uint32)
        for at in range(0, len(of), GATHERED):
            some = of[at : at + GATHERED]
            lo, hi = ends[at], ends[at + len(some)]
            ids[lo:hi] = flat[np.repeat(start[some] - (ends[at : at + len(some)] - lo), length[some]) + np.arange(hi - lo)]
        return ids, ends[np.searchsorted(places, begin)]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def slices(rows: pa.Table, column: str = "text") -> Iterator[pa.Table]:
    """The rows in parts of about SLICE text bytes, the text as large string."""
    at = rows.schema.get_field_index(column)
    rows = rows.set_column(at, column, rows[column].cast(pa.large_string()))
    texts = rows[column].combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield rows.slice(at, stop - at)
        at = stop


def _encoded(path: str, end: int, small: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype("<u2" if small else "<u4")
        for rows in gathered(batches, SLICE):
            for part in slices(rows):
                texts = part["text"].combine_chunks()
                texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
                ids, begin = encoder(path).encode(texts)
                length = np.diff(begin)
                out = np.empty(len(ids) + len(length), kind)
                last = np.cumsum(length + 1) - 1
                ends = np.zeros(len(out), bool)
                ends[last] = True
                out[ends], out[~ends] = end, ids
                offsets = (np.concatenate([[0], last + 1]) * kind.itemsize).astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].combine_chunks(), pa.array(length + 1), data], ["doc_id", "n_tokens", "ids"]
                )

    return run


def width(path: str, end: int) -> int:
    """Bytes that an id of this tokenizer takes when stored."""
    return 2 if max(encoder(path).size - 1, end) < 1 << 16 else 4


def tokenized(docs: DataFrame, end: int, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian, ``width`` bytes each) of every row; ``end`` closes each text."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    schema = "doc_id long, n_tokens long, ids binary"
    return given.mapInArrow(lean(_encoded(path, end, width(path, end) == 2)), schema)


def as_ids(column: pa.Array, size: int) -> np.ndarray:
    """All ids of a binary column without nulls, one row after the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    count = (int(offsets[-1]) - int(offsets[0])) // size
    if not count:
        return np.zeros(0, f"<u{size}")
    return np.frombuffer(column.buffers()[2], f"<u{size}", count, int(offsets[0]))

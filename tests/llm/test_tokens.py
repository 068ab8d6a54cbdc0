import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as hyp
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagloom.llm import common, packing, token_files, tokens

from .conftest import MESSY

PATH = tokens.default_path()
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tokens.Encoder(PATH)
PARTS = ["a", "b", " ", "  ", "\n", "é", "ß", "1", "'s", "!", " ", "日", "́", " ", "<|endoftext|>", "\t", "Ã", "\U0001f600"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@hyp(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), max_size=5))
def test_same_ids_as_the_library_on_whole_texts(texts):
    ids, begin = ENCODER.encode(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        assert ids[begin[i] : begin[i + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_many_joined_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "JOINED", 50)
    monkeypatch.setattr(tokens, "GATHERED", 7)
    rnd = random.Random(2)
    text = " ".join("".join(rnd.choice("abcdé1.") for _ in range(rnd.randrange(1, 8))) for _ in range(2000))
    ids, _ = ENCODER.encode(pa.array([text], pa.large_string()))
    assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@hyp(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), max_size=6))
def test_packed_numbers_round_trip(lists):
    counts = np.array([len(x) for x in lists], np.int64)
    values = np.array([v for x in lists for v in x], np.uint32)
    control, data, controls, sizes = token_files.pack(values, counts)
    assert controls.tolist() == [-(-len(x) // 4) for x in lists] and sizes.sum() == len(data)
    assert token_files.unpack(control, data, counts).tolist() == values.tolist()


def expected_ids(rows, end):
    return [LIBRARY.encode(t or "", add_special_tokens=False).ids + [end] for _, t in rows]


def test_files_hold_whole_texts_in_order(spark, messy, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 10)
    token_files.write(messy, str(tmp_path / "f"))
    got = sorted(token_files.read(spark, str(tmp_path / "f")).collect(), key=lambda r: r["start"])
    rows = sorted([r[:2] for r in MESSY], key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    assert sorted(np.frombuffer(r["ids"], "<u4").tolist() for r in got) == sorted(expected_ids(rows, 2))
    n = np.array([r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == (np.cumsum(n) - n).tolist()


def test_no_documents(spark, none, tmp_path):
    token_files.write(none, str(tmp_path / "f"))
    assert token_files.read(spark, str(tmp_path / "f")).count() == 0
    assert packing.pack(none).count() == 0


def test_op3_on_given_documents(spark, given):
    rows = [(r["doc_id"], r["text"]) for r in given[1]]
    ids = expected_ids(rows, 2)
    got = sorted(map(tuple, token_files.op3_token_files(spark, "/root/testdata/sf0.001").collect()))
    start, out = 0, []
    for (i, _), x in zip(rows, ids):
        out.append((i, start, len(x), crc(x)))
        start += len(x)
    assert got == out


@pytest.mark.parametrize("n", [0, 3, 60, 3000])
def test_patterns_meet_the_demand_with_little_waste(n):
    rng = np.random.default_rng(n)
    demand = np.bincount(rng.integers(1, 33, n), minlength=33)
    found = packing.cutting_stock(demand)
    total = sum(t * p for t, p in found) if found else np.zeros(33, int)
    assert (total == demand).all()
    assert all(p @ np.arange(33) <= 32 for _, p in found)
    need = demand @ np.arange(33)
    assert 32 * sum(t for t, _ in found) <= need * 1.02 + 3 * 32


def check_pieces(pieces, rows):
    """Every id is in one piece, and sequences are filled from 0 without a gap."""
    ids = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        ids.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    text_ids = sorted((i, x) for (i, _), x in zip(rows, expected_ids(rows, 0)))
    got = sorted((k[0], [v for p in ps for v in np.frombuffer(p["ids"], "<u4").tolist()]) for k, ps in ids.items())
    assert got == text_ids
    sequences = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return sequences


def test_packing_given_documents(given):
    rows = [(r["doc_id"], r["text"]) for r in given[1]]
    sequences = check_pieces(packing.pack(given[0]).collect(), rows)
    used = sum(n for parts in sequences.values() for _, n in parts)
    assert len(sequences) * 1024 <= used * 1.02


def test_packing_messy_documents(messy):
    pieces = packing.pack(messy).collect()
    assert sum(p["length"] for p in pieces) == sum(map(len, expected_ids([r[:2] for r in MESSY], 0)))
    places = [(p["sequence_id"], p["offset"]) for p in pieces]
    assert len(set(places)) == len(places)


@hyp(st.lists(st.lists(st.sampled_from([*"ab Z9é×÷.,'!s\n\t#-\"ß€<| ", "<|endoftext|>"]), max_size=40).map("".join), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_cut_and_kept_pieces_have_the_ids_of_whole_texts(texts):
    """One encoder over many batches, so that pieces kept from earlier ones are used."""
    encoder = tokens.encoder(tokens.default_path())
    ids, begin = encoder.encode(pa.array(texts, pa.large_string()))
    for k, text in enumerate(texts):
        assert ids[begin[k] : begin[k + 1]].tolist() == encoder.library.encode(text, add_special_tokens=False).ids
    assert len(encoder.kept[0]) <= tokens.KEPT


def test_few_pieces_are_kept(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 3)
    encoder = tokens.Encoder(tokens.default_path())
    for text in ["a b b b c c d d d d", "b d x y y y " * 3, ""]:
        ids, _ = encoder.encode(pa.array([text], pa.large_string()))
        assert ids.tolist() == encoder.library.encode(text, add_special_tokens=False).ids and len(encoder.kept[0]) <= 3


def test_a_stretch_of_text_bounds_a_worker(monkeypatch):
    """What the encoder is given at once is at most 6 MB, and what it used goes back to the system when a task's rows are done."""
    seen, given_back = [], []

    class Plain:
        size = 100

        def encode(self, texts):
            seen.append(texts.nbytes)
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)

    class Pool:
        def release_unused(self):
            given_back.append(len(seen))

    monkeypatch.setattr(tokens, "encoder", lambda path: Plain())
    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1000)), "text": pa.array(["x" * 10_000] * 1000)})
    rows = sum(b.num_rows for b in common.lean(tokens._encoded("", 0, True))(iter([batch, batch])))
    assert rows == 2000 and max(seen) < 6.1 * 2**20 and given_back == [len(seen)]

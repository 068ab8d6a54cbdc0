import re

import numpy as np
import pytest
import xxhash

from tagloom.llm import simhash
from tagloom.llm.components import components

from .conftest import MESSY


def plain(text, words=3):
    tokens = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("text", ["", " \n", "one", "Two words", "a b c", "ÄÖ Üß X y z", "w " * 500, "A b\tc\x0bd\x1fe f"])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == plain(text)


@pytest.mark.parametrize("wide,radius", [(1, 3), (2, 25)])
def test_bit_sliced_groups_equal_plain_ones(wide, radius):
    rng = np.random.default_rng(wide)
    seeds = rng.integers(0, 2**63, (12, wide), dtype=np.uint64)
    fps, runs = [], []
    for run, n in enumerate([1, 2, 150, 5, 70]):
        for _ in range(n):
            x = seeds[rng.integers(0, 12)].copy()
            for _ in range(rng.integers(0, radius)):
                x[rng.integers(0, wide)] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
            fps.append(x)
            runs.append(run)
    fps, runs = np.array(fps), np.array(runs)
    near = lambda i, j: runs[i] == runs[j] and np.bitwise_count(fps[i] ^ fps[j]).sum() <= radius
    assert simhash._within(fps, runs, radius).tolist() == roots(len(fps), near)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 201), (300, 200), (5, 5)]
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 0, 201: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("part", [4096, 8])
def test_marks_as_brute_force(given, part, monkeypatch):
    monkeypatch.setattr(simhash, "PART", part)
    frame, rows = given
    fps = [plain(r["text"]) for r in rows]
    root = roots(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    expected = [(r["doc_id"], f"{f:016x}", rows[k]["doc_id"]) for r, f, k in zip(rows, fps, root)]
    assert sorted(map(tuple, simhash.mark(frame).collect())) == expected


def test_messy_and_empty(messy, none):
    got = {(r[0], r[1]): r[2] for r in simhash.mark(messy).collect()}
    assert got[5, "0" * 16] == got[6, "0" * 16] == got[None, "0" * 16] == 5
    assert got[3, f"{plain(MESSY[0][1]):016x}"] == got[9, f"{plain(MESSY[0][1]):016x}"] == 3
    assert len(simhash.mark(messy).collect()) == len(MESSY)
    assert simhash.mark(none).count() == simhash.deduplicate(none).count() == 0
    kept = simhash.deduplicate(messy)
    assert kept.columns == messy.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [3, 5, 7, 11]


def test_one_document_of_each_component_stays(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choice(words, 300)) for _ in range(40)]
    rows = []
    for i, text in enumerate(texts):
        rows += [(3 * i, text, "x"), (3 * i + 1, text.upper(), "y"), (3 * i + 2, text.replace(" ", "  "), "z")]
    rows += [(0, texts[1], "repeated id"), (None, texts[2], "no id"), (None, "alone and without an id", "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint_of string").repartition(5)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in simhash.deduplicate(frame).collect())
    # Texts 0 and 1 are one row by id 0 each, and different fingerprints: both stay, and text 1's other rows go.
    stay = [(3 * i, t) for i, t in enumerate(texts) if i != 1] + [(0, texts[1]), (-1, "alone and without an id")]
    assert got == sorted(stay) and simhash.deduplicate(frame).columns == frame.columns

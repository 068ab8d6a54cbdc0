"""Collocations against plain counts of strings."""

import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import collocations
from tagloom.llm.collocations import STRETCH, Words, cut

from .conftest import MESSY

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score, doc_id) from (doc_id, text, lang)."""
    counts, where = Counter(), {}
    for doc, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LETTERS)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] += 1
                    if doc is not None:
                        where[key] = min(doc, where.get(key, doc))
    out = []
    for lang in {g for g, _ in counts}:
        n = sum(c for (g, w), c in counts.items() if g == lang and len(w) == 1)
        some = {w: c for (g, w), c in counts.items() if g == lang and len(w) > 1 and c >= least}
        kept = []
        for w, a in some.items():
            if any(len(x) > len(w) and 100 * c >= 50 * a and w in (x[:2], x[1:]) for x, c in some.items()):
                continue
            score, k, l, r = min((10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
            kept.append((-score, -a, " ".join(w).encode(), l, r, where.get((lang, w))))
        for rank, (score, a, phrase, l, r, doc) in enumerate(sorted(kept, key=lambda x: x[:3])[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, l, r, n, -score, doc))
    return sorted(out)


def found(frame, **options):
    return sorted(map(tuple, collocations.collocations(frame, **options).collect()))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    words = ["the", "The", "of", "naïve", "x", "ÄÖ", "\U0001f600", "b\x1fc", "d e"]
    rows = []
    for i in range(400):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ! "], p=[0.7, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03])) for _ in range(rng.integers(0, 60)))
        rows.append((int(rng.integers(0, 300)) if i % 50 else None, text if i % 37 else None, [None, "en", "de", ""][int(rng.integers(0, 4))]))
    return rows


@pytest.mark.parametrize("size,bits,top", [(STRETCH, 1 << 27, 2000), (97, 1 << 6, 7)])
def test_as_plain_counts(spark, texts, size, bits, top, monkeypatch):
    """Also in stretches of a few words and with a map so small that nearly every fingerprint is marked."""
    plainly = collocations.phrases
    monkeypatch.setattr(collocations, "phrases", lambda docs, least: plainly(docs, least, bits, size))
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(5)
    expected = plain(texts, top=top)
    assert len(expected) > 20 and found(frame, top=top) == expected


@pytest.mark.parametrize("size", [1, 9, 40, 10_000])
def test_cut_texts_have_the_same_runs(size):
    text = ("aa bb  cc\tdd ee. ff gg hh ii jj kk ll,mm " * 6 + "x" * 50 + " nn oo").encode()
    for order in (1, 2, 3):
        whole = Words([(text, 0, 0)])
        parts = list(cut(text, size))
        several = Words([(t, r, k) for k, (t, r) in enumerate(parts)])
        same = [w.phrases(w.runs(order), order).to_pylist() for w in (whole, several)]
        assert sorted(same[0]) == sorted(same[1]) and len(same[0]) > 40


def test_equal_runs_have_equal_fingerprints():
    words = Words([(b"one two  three. one\ttwo three four", 0, 0), (b"two three", 0, 1), (b"one two three", 0, 2)])
    salt = np.array([5, 5, 6], np.uint64)
    for order in (1, 2, 3):
        first = words.runs(order)
        keys = [(p, int(salt[t])) for p, t in zip(words.phrases(first, order).to_pylist(), words.text[first])]
        prints = words.prints(first, order, salt).tolist()
        assert len(set(keys)) == len(set(prints)) == len(set(zip(keys, prints)))


def test_colliding_fingerprints_are_told_apart(monkeypatch):
    monkeypatch.setattr(collocations, "_VALUES", np.full(256, 3, np.uint64))  # runs of equal length collide
    rows = [(i, "ab cd ef, ab cx. zz yy", "en") for i in range(3)] + [(None, "ab zz, ab qq", "en")]
    ids, texts, langs = zip(*rows)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "lang": langs, "text": texts})
    prints = next(collocations._counted(2, None, STRETCH)([batch])).to_pydict()
    assert len(prints["print"]) == 1 and prints["n"] == [14]
    marks = np.zeros(1, np.uint64)
    marks[0] = 1 << (prints["print"][0] & 63)
    every = SimpleNamespace(value=marks)
    for pointers, known in ((False, {"cd": 3}), (True, {})):
        read = collocations._read([every, every], STRETCH, pointers)
        got = {r["name"]: r["n"] for b in read([batch]) for r in b.to_pylist()}
        one, none = (0, None) if pointers else (3, 1)
        pairs = {"ab cd": one, "cd ef": one, "ab cx": one, "zz yy": one, "ab zz": none, "ab qq": none}
        assert {p: got[f"en\n{p}"] for p in pairs} == pairs and {w: got[f"en\n{w}"] for w in known} == known


def test_parts_of_longer_phrases_are_dropped(spark):
    rows = [(i, "big red dog. red dog. the end", "en") for i in range(10)] + [(i, "red dog, red dog", "en") for i in range(6)]
    rows += [(99, "big red", "en")] * 9 + [(98, "red dog", "en")]
    got = {r[2]: r[3] for r in found(spark.createDataFrame(rows, "doc_id long, text string, lang string"))}
    # "red dog" stands 33 times, more than twice as often as "big red dog"; "big red" 19 times, less than twice.
    assert got == {"big red dog": 10, "red dog": 33, "the end": 10} == {r[2]: r[3] for r in plain(rows)}


def test_messy_and_empty(messy, none):
    """One very long text makes the only phrases; extra columns do not matter."""
    rows = [(r[0], r[1], r[2]) for r in MESSY]
    assert found(messy) == plain(rows) and len(plain(rows)) > 0
    assert found(none) == []

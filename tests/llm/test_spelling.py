"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from tagloom.llm import spelling
from tagloom.llm.spelling import Acceptor

from .conftest import MESSY


def vocabulary(rows, least=3):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if n >= least and len(w) >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    words = vocabulary(rows)
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    about = {w: [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, []) if near(w, x)] for w in words}
    form = {}
    for w, some in about.items():
        best = min(some, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(about[w]), words.get(form[w])))
    return sorted(out, key=lambda r: r[0])


def found(frame, **options):
    got = spelling.variants(frame, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(map(tuple, got), key=lambda r: r[0])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "abababa", "×÷×÷×"]
    rows = []
    for i in range(500):
        some = []
        for w in rng.choices(base, [1 / (k + 1) for k in range(len(base))], k=20):
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1 :], w[:p] + rng.choice("abcÉ") + w[p:], w[:p] + rng.choice("abc") + w[p + 1 :]])
            some.append(w.upper() if w.isascii() and rng.random() < 0.2 else w)
        rows.append((i if i % 9 else None, rng.choice([" ", "-", "1"]).join(some) if i % 31 else None))
    return rows


@pytest.mark.parametrize("limit", [spelling.LIMIT, 30, 2])
def test_as_all_pairs(spark, texts, limit):
    """Also where nearly every initial state is moved on."""
    expected = plain(texts)
    assert len(expected) > 300 and sum(r[1] is not None for r in expected) > 100 and any(r[1] != r[2] and r[1] for r in expected)
    assert found(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), limit=limit) == expected


def test_given_documents(spark, given):
    rows = [(r["doc_id"], r["text"]) for r in given[1]]
    assert found(given[0]) == plain(rows)


def test_acceptor_is_minimal_and_composes_to_all_pairs():
    rng = random.Random(2)
    for letters in ("ab", "abcd"):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(4, 5))) for _ in range(60)})
        made = Acceptor(words)
        accepted = [("", made.start)]
        language = []
        while accepted:
            text, state = accepted.pop()
            language += [text] if made.final[state] else []
            accepted += [(text + b, to) for b, to in made.arcs[state].items()]
        assert sorted(language) == words
        tails = {}  # Two states that accept the same rests would be one
        for state in range(len(made.arcs)):
            rests, todo = set(), [("", state)]
            while todo:
                text, at = todo.pop()
                rests |= {text} if made.final[at] else set()
                todo += [(text + b, to) for b, to in made.arcs[at].items()]
            tails[state] = frozenset(rests)
        assert len(set(tails.values())) == len(tails)
        got = sorted(made.composed(4))
        assert got == sorted({(a, b) for a in words for b in words if near(a, b) and len(a) == 4 and (len(b) == 5 or a < b)})
        first = [(a, b) for a, b in got if a[:1] != b[:1]]
        assert sorted(made.composed(4, only_first=True)) == first


def test_long_words_take_little_time(spark):
    long = ["x" * 20_000, "x" * 20_001, "x" * 9_999 + "y" + "x" * 10_000]
    rows = [(i, " ".join(long[: 1 + i % 3])) for i in range(12)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    words = vocabulary(rows)
    assert {r[0]: r[3] for r in got} == words
    assert {r[0]: r[4] for r in got} == {w: sum(near(w, x) for x in words) for w in words}


def test_cut_texts_have_the_same_words(monkeypatch):
    text = "Größe naïve-word " * 30 + "x" * 50 + " END!"
    whole = spelling.words_of("7", text)
    monkeypatch.setattr(spelling, "STRETCH", 11)
    assert spelling.words_of("7", text) == whole and whole["x" * 50] == 1


def test_messy_and_empty(messy, none):
    rows = [(r[0], r[1]) for r in MESSY]
    assert found(messy) == plain(rows)
    assert found(none) == []

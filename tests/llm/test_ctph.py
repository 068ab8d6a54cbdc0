from hashlib import sha256

import pytest
from hypothesis import given as hyp
from hypothesis import strategies as st

from tagloom.llm import ctph

from .conftest import MESSY


def plain_signature(data, size):
    """The same signature, byte by byte."""
    mask = (1 << 64) - 1
    out, hashed, place = "", 0, 0
    ends = 0
    for i in range(len(data)):
        hashed = (hashed + (data[i] + 1) * pow(int(ctph._FACTOR), place, 1 << 64)) & mask
        place += 1
        rolling = sum(data[i - k] * int(ctph._WEIGHTS[k]) for k in range(min(7, i + 1))) & mask
        rolling ^= rolling >> 29
        rolling = (rolling * int(ctph._MIX) & mask) >> 16
        if (rolling + 1) % size == 0 and ends < 63:
            hashed ^= hashed >> 32
            out += ctph.ALPHABET[(hashed * int(ctph._MIX) & mask) >> 58]
            hashed, place, ends = 0, 0, ends + 1
    if place:
        hashed ^= hashed >> 32
        out += ctph.ALPHABET[(hashed * int(ctph._MIX) & mask) >> 58]
    return out


@pytest.mark.parametrize("text", ["a", "short text", "Größe \U0001f600 " * 30, "abc def ghi " * 90, "x" * 400, "".join(chr(33 + i * i % 90) for i in range(3000))])
def test_fingerprint_equals_the_plain_one(text):
    size, *signatures = ctph.fingerprint(text).split(":")
    assert signatures == [plain_signature(text.encode(), int(size) << j) for j in range(3)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] if x == y else 1 + min(row[j], new[-1]))
        row = new
    return row[-1]


@hyp(st.text("abc", max_size=70), st.text("abcd", max_size=70))
def test_common_subsequence_is_the_edit_distance(a, b):
    assert len(a) + len(b) - 2 * ctph.common_subsequence(a, b) == edit_distance(a, b)


def test_likeness():
    one = ctph.fingerprint("".join(chr(97 + i * i * i % 25) for i in range(2500)))
    assert ctph.likeness(one, one) == 1.0
    assert ctph.likeness(one, ctph.fingerprint("")) == 0.0
    assert ctph.likeness(ctph.fingerprint(""), ctph.fingerprint("")) == 1.0
    assert ctph.likeness("3:AAAA::", "24:AAAA::") == 0.0


def test_op1_on_given_documents(spark, given):
    rows = given[1]
    got = {r["doc_id"]: r for r in ctph.op1_fingerprints(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    better = 0
    for i, r in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)]["text"]
        half = len(r["text"]) // 2
        changed = r["text"][: len(r["text"]) - half] + nxt[:half]
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(r["text"]) and g["edited_sha256"] == sha256(changed.encode()).hexdigest()
        assert g["fingerprint"] == ctph.fingerprint(r["text"]) and g["edited_fingerprint"] == ctph.fingerprint(changed)
        assert 0 <= g["near_next"] <= 1 and 0 <= g["near_edited"] <= 1
        better += g["near_edited"] > g["near_next"]
    assert better >= 0.97 * len(rows)


def test_messy_and_empty(spark, messy, none):
    got = ctph.compare_next(messy).collect()
    assert len(got) == 9 and sum(r["doc_id"] is None for r in got) == 2
    last = next(r for r in got if r["doc_id"] == 11)  # is followed by the first, a row without an id
    firsts = [r[1] for r in MESSY if r[0] is None]
    assert last["edited_sha256"] in {sha256(ctph.edited(MESSY[-1][1], t).encode()).hexdigest() for t in firsts}
    assert ctph.compare_next(none).count() == 0
    single = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert ctph.compare_next(single).first()["edited_sha256"] == sha256(b"abcabc").hexdigest()
    prints = ctph.fingerprints(messy.withColumnRenamed("kept", "fingerprint"))
    assert prints.columns.count("fingerprint") == 1 and prints.count() == 9

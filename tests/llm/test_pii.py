import random
import re
from collections import Counter
from hashlib import sha256

import pytest

from tagloom.llm import pii

KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def digest(doc_id, text):
    spans = base(text or "")
    joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return (doc_id, *(sum(k == i for _, k, _ in spans) for i in range(4)), sha256(joined.encode()).hexdigest())


def agree(docs):
    got = pii.find(docs).collect()
    expected = [digest(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == Counter(expected)
    for r in got:
        places = [(x["start"], x["kind"]) for x in r["found"]]
        assert places == sorted(places) and sum(x["base"] for x in r["found"]) == sum(r[f"n_{k}"] for k in KINDS)
        assert r["spans"] == ",".join(f"{pii.KINDS[x['kind']]}:{x['start']}:{x['end']}" for x in r["found"])
    return got


PARTS = ["a", "b", "@", ".", "c-d", " ", "  ", "-", "1", "23", "456", "+", "(", ")", "é", "\U0001f600", "\n", "255.", "4111 1111 1111 1111", "+1 (017) 555-7713", "x@y.z", "_", "%", "", "1.2.3.4", "9" * 21]
HARD = [None, "", "a@b-c.d_x@e.f", "1.2.3.4.5.6.7.8", "a@b.c@d.e", "+1" + "2" * 14, "1" * 5000, "1 " * 20000, "a" * 200000, "+1 " * 3000, "a@b" + ".c" * 20000]


def test_base_spans_equal_plain_ones(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(40))) for _ in range(1500)] + HARD
    agree(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))


def test_messy_and_empty(messy, none):
    got = agree(messy)
    assert sum(r["n_phone"] + r["n_ip"] for r in got) == 2
    assert pii.find(none).count() == 0


def test_given_documents_and_added_keys(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = agree(frame)
    texts = dict(frame.collect())
    secrets = [(r["doc_id"], x) for r in got for x in r["found"] if pii.KINDS[x["kind"]] == "secret"]
    assert secrets and all(texts[i][: x["start"]].endswith('token = "') for i, x in secrets)


def test_no_python_runs(given):
    plan = pii.candidates(given[0])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_reliabilities_tell_good_labelers_from_bad():
    rnd = random.Random(1)
    patterns = Counter()
    for _ in range(5000):
        truth = rnd.random() < 0.4
        sure = [int(truth) if rnd.random() < 0.9 else 1 - truth for _ in range(3)]
        patterns[(4, *sure, 2, rnd.randrange(2))] += 1
    belief = pii.reliabilities(dict(patterns))
    assert belief[4, 1, 1, 1, 2, 0] > 0.95 and belief[4, 0, 0, 0, 2, 1] < 0.05
    weights = pii.span_classifier(dict(patterns), belief)
    score = lambda p: pii._sigmoid(sum(weights[i] for i in pii._inputs(p)))
    for p, b in belief.items():
        assert abs(score(p) - b) < 0.25
    assert pii.span_classifier({}, {}) == [0.0] * (1 + len(pii.KINDS) + 2 * len(pii.LABELERS))


@pytest.mark.parametrize("number,ok", [("4111111111111111", True), ("4111111111111112", False), ("0" * 14, True)])
def test_luhn(spark, number, ok):
    assert spark.createDataFrame([(number,)], "d string").select(pii.luhn(pii.F.col("d"))).first()[0] is ok

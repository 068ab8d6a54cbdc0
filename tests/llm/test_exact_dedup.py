from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from tagloom.llm import exact_dedup
from tagloom.llm.exact_dedup import Directory
from .conftest import LONG, MESSY


def test_directory_splits_overfull_buckets_and_doubles():
    rng = np.random.default_rng(1)
    histogram = np.bincount(rng.integers(0, 256, 400) // 3, minlength=256)
    grown = Directory.grown(histogram, 20)
    cells = np.arange(256, dtype=np.uint64) << np.uint64(56)
    owner = grown.owner(cells)
    assert (np.diff(owner) >= 0).all() and set(owner) == set(range(len(grown.buckets)))
    held = np.bincount(owner, histogram)
    for n, (prefix, depth) in zip(held, grown.buckets):
        assert n <= 20 or depth == 8
        assert depth <= grown.depth and prefix < 1 << depth
    assert Directory.grown(np.zeros(16, int)).owner(cells).tolist() == [0] * 256


def test_directory_with_a_hot_cell_stops_at_its_last_bit():
    histogram = np.zeros(16, int)
    histogram[5] = 1000
    grown = Directory.grown(histogram, 10)
    assert grown.depth == 4 and (5, 4) in grown.buckets


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = True
        for i in ids:
            kept = i == keep and stays
            stays = stays and not kept
            out[i, keep, len(ids), kept, sha256(text.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("capacity", [1, 20_000])
def test_marks(messy, capacity):
    got = exact_dedup.mark(messy, capacity)
    assert "bucket" in got.columns and got.columns.count("kept") == 1
    rows = got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert Counter(map(tuple, rows)) == brute([r[:2] for r in MESSY])


def test_deduplicates_with_the_given_columns(messy):
    got = exact_dedup.deduplicate(messy)
    assert got.columns == messy.columns
    texts = Counter(r["text"] or "" for r in got.collect())
    assert set(texts.values()) == {1} and texts[LONG] == 1


def test_hot_text_and_empty_table(spark, none):
    assert exact_dedup.mark(none).count() == 0
    hot = spark.range(6000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id)) AS text")
    got = exact_dedup.mark(hot, 500)
    assert got.where("kept").count() == 4001
    assert got.where("text = 'hot' AND keep_id = 5997 AND group_size = 2000").count() == 2000

from __future__ import annotations

import pytest

from tagloom.llm.queries import with_package

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, bucket int, part string"

LONG = "word " * 60_000 + "a@b.org " + "x" * 30_000
MESSY = [
    (3, "The same text twice.", "en", "a", 1, "k", "s", 1, "p"),
    (9, "The same text twice.", "en", "a", 1, "k", "s", 1, "p"),
    (9, "The same text twice.", "en", "a", 1, "k", "s", 1, "p"),
    (5, None, None, None, None, None, None, None, None),
    (6, "", "de", "b", 0, None, None, None, None),
    (7, LONG, "en", None, 5, None, None, None, None),
    (None, "No id here, call +1 (017) 555-7713 or x.y@mail.example.com now", "fr", "b", 2, None, None, None, None),
    (None, "   \t\n ", "fr", "c", 2, None, None, None, None),
    (11, "Größe \U0001f600 naïve\nline two 1.2.3.4", "de", "c", 2, None, None, None, None),
]


@pytest.fixture(autouse=True)
def package(spark):
    with_package(lambda s: None)(spark)


@pytest.fixture
def messy(spark):
    return spark.createDataFrame(MESSY, COLUMNS).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def given(spark):
    """The given documents, as a frame and in order of their ids."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    return frame, sorted(frame.select("doc_id", "text", "source", "lang").collect())

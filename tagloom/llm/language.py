"""Language identification with hyperdimensional profiles.

Every character has a random vector of +1 and -1. An n-gram's vector binds (multiplies) those of its characters, each rotated by
its place; a text bundles (adds) the vectors of all its n-grams, and a language those of its texts, scaled to equal length. A
text's language is the prototype of the largest cosine. All vectors come from a seed, so every task makes the same ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tagloom.llm.common import table, without
from tagloom.llm.quality import in_fold

DIMENSIONS = 1024
GRAM = 3
SEED = 11
#: n-gram vectors that a worker keeps, and characters counted at a time.
KEPT, STRETCH = 1 << 15, 1 << 20
UNKNOWN = "und"

OUTPUTS = ("lang_pred", "score")


class Space:
    """Vectors of n-grams, made as they are met."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.int64)
        self.place = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, self.dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng((self.seed, code)).integers(0, 2, self.dimensions, np.int8) * 2 - 1
        return self.letters[code]

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """A row for each n-gram (its characters, 21 bits each)."""
        at = np.minimum(np.searchsorted(self.known, codes), max(len(self.known) - 1, 0))
        new = codes[self.known[at] != codes] if len(self.known) else codes
        if len(new):
            if len(self.known) + len(new) > KEPT:
                self._forget()
                new = codes
            made = np.ones((len(new), self.dimensions), np.int8)
            for turn in range(GRAM):
                letters, which = np.unique(new >> (21 * turn) & 0x1FFFFF, return_inverse=True)
                made *= np.array([np.roll(self.letter(int(c)), turn) for c in letters])[which]
            self.vectors = np.concatenate([self.vectors, made])
            known = np.concatenate([self.known, new])
            place = np.concatenate([self.place, np.arange(len(self.place), len(known))])
            order = np.argsort(known)
            self.known, self.place = known[order], place[order]
            at = np.searchsorted(self.known, codes)
        return self.vectors[self.place[at]]


def characters(text: str) -> np.ndarray:
    """Lower-case letters of a text, each stretch of anything else as one space; empty without a letter.

    A letter is what Python's ``str.isalpha`` says.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    kinds, which = np.unique(codes, return_inverse=True) if (codes > 0x24F).any() else (np.arange(0x250), codes)
    letter = _latin() if len(kinds) == 0x250 and kinds[-1] == 0x24F else np.array([chr(c).isalpha() for c in kinds], bool)
    is_letter = letter[which]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(is_letter, codes, 32)
    return codes[np.r_[True, is_letter[1:] | is_letter[:-1]]]


_LATIN = np.array([chr(c).isalpha() for c in range(0x250)])


def _latin() -> np.ndarray:
    return _LATIN


def text_vector(text: str, space: Space) -> np.ndarray | None:
    """The bundle of a text's n-grams; None without a letter. Spaces stand before and after the text."""
    codes = characters(text)
    if not len(codes):
        return None
    codes = np.concatenate([[32], codes, [32]])
    grams = codes[2:] | codes[1:-1] << 21 | codes[:-2] << 42
    total = np.zeros(space.dimensions, np.float32)
    for at in range(0, len(grams), STRETCH):
        kinds, counts = np.unique(grams[at : at + STRETCH], return_counts=True)
        for lo in range(0, len(kinds), KEPT // 8):
            total += counts[lo : lo + KEPT // 8].astype(np.float32) @ space.grams(kinds[lo : lo + KEPT // 8]).astype(np.float32)
    return total


@dataclass
class Profiles:
    """The prototypes' names and unit vectors."""

    names: list[str]
    vectors: np.ndarray
    seed: int = SEED

    def predict(self, text: str | None, space: Space) -> tuple[str, float]:
        vector = text_vector(text, space) if text else None
        if vector is None or not self.names:
            return UNKNOWN, 0.0
        cosines = self.vectors @ (vector / max(float(np.linalg.norm(vector)), 1e-9))
        best = int(cosines.argmax())
        return self.names[best], float(min(max(cosines[best], 0.0), 1.0))


def _bundles(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(seed=seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                vector = text_vector(text, space)
                if vector is not None and vector.any():
                    sums.setdefault(lang, np.zeros(space.dimensions))
                    # Rounded, so that the sum does not depend on the order of the tasks.
                    sums[lang] += np.rint(vector / np.linalg.norm(vector) * 2**20)
        for lang, total in sums.items():
            n = space.dimensions
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n), pa.array(range(n)), pa.array(total)], ["lang", "at", "value"])

    return run


def train(docs: DataFrame, allowed: Column, seed: int = SEED) -> Profiles:
    """Profiles from ``text`` and ``lang`` (neither null) of the ``allowed`` rows.

    All of them are learned from, so a rare language has its profile too. Each task adds up its own, and the driver gets one
    vector per language.
    """
    rows = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    parts = rows.select("lang", "text").mapInArrow(_bundles(seed), "lang string, at long, value double")
    sums: dict[str, np.ndarray] = {}
    for lang, at, value in parts.groupBy("lang", "at").agg(F.sum("value")).collect():
        sums.setdefault(lang, np.zeros(DIMENSIONS))[at] = value
    names = sorted(n for n, v in sums.items() if v.any())
    vectors = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names]).reshape(len(names), DIMENSIONS)
    return Profiles(names, vectors.astype(np.float32), seed)


def predictor(profiles: Profiles) -> Callable[[Column], Column]:
    kind = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    @F.pandas_udf(kind)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space = Space(seed=profiles.seed)
        for texts in batches:
            yield pd.DataFrame([profiles.predict(t, space) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the cosine, 0 to 1).

    ``und`` and 0 for null texts and texts without a letter; of equal cosines the first name in order wins. Rows repeat as given.
    """
    docs = without(docs, *OUTPUTS)
    found = docs.withColumn("_p", predictor(profiles)(F.col("text").cast("string")))
    return found.withColumn("lang_pred", F.col("_p.lang_pred")).withColumn("score", F.col("_p.score")).drop("_p")


def op9_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    profiles = train(docs, ~held_out)
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles).drop("text")

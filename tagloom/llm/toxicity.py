"""Toxicity by cumulative-link ordinal regression on sparse text features.

A text's features are its words and their beginnings (a language that builds words tells by these), hashed, each weighted by
1 + log(count) / 4. One weight vector is shared by all grades; each boundary between neighbouring grades has a threshold of its
own: ``P(grade > k) = sigmoid(w.x - threshold_k)``. The expected severity is the sum of these probabilities. Weights are kept
sparse by an L1 penalty (proximal gradient steps).

Labels only say whether a text is toxic. Grades come from them in two rounds: a fit with one boundary ranks the toxic texts, and
those of the upper half get the higher grade. The severity from which a text is rejected comes from severities that each
labelled text gets from a model of the other folds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tagloom.llm.common import table, unused, whole_text, without
from tagloom.llm.quality import in_fold, labelled_sample

#: Learned from at most so many labelled texts of each class.
SAMPLE = 3000
CELLS = 1 << 18
#: Letters of a word's beginnings.
BEGINNINGS = (3, 4, 5, 6)
#: A feature takes part if so many texts of the sample have it (near copies count as one), and if its share of the toxic texts
#: is so many times its share of the others: weights are never negative, so a feature of both classes would stay at 0.
RARE, LIFT = 5, 1.5
PENALTY, ROUNDS = 1e-3, 300
#: The cut is chosen on so many folds. Of clean texts it rejects at most this share, and one that it rejects counts like so many
#: toxic ones that it does not (as shares of their class).
FOLDS, REJECTED, WRONGED = 5, 0.01, 5.0
#: Text characters split into words at a time.
STRETCH = 1 << 16

WORD = regex.compile(r"\p{L}+")

OUTPUTS = ("severity", "score", "grade", "predicted")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a text's words (any letters, lower case) and of their beginnings, and the weights of the cells.

    Other characters separate words.
    """
    counts: dict[str, int] = {}
    at = 0
    while at < len(text):
        stop = at + STRETCH
        while stop < len(text) and text[stop - 1].isalpha() and stop - at < 2 * STRETCH:
            stop += 1
        for word in WORD.findall(text[at:stop].lower()):
            counts[word] = counts.get(word, 0) + 1
        at = stop
    begun: dict[str, int] = {}
    for word, n in counts.items():
        for k in BEGINNINGS:
            if len(word) <= k:
                break
            begun[word[:k]] = begun.get(word[:k], 0) + n
    cells: dict[int, int] = {}
    for seed, found in ((5, counts), (6, begun)):
        for word, n in found.items():
            cell = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"), seed) % CELLS
            cells[cell] = cells.get(cell, 0) + n
    where = np.fromiter(cells.keys(), np.int32, len(cells))
    return where, (1.0 + 0.25 * np.log(np.fromiter(cells.values(), float, len(cells)))).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class OrdinalModel:
    """Weights of the cells in use, ascending thresholds, and the expected severity from which a text is rejected."""

    cells: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5

    def above(self, text: str) -> np.ndarray:
        """The probability of a grade above each threshold."""
        return _sigmoid(self._raw(*features(text)).sum() - self.thresholds)

    def _raw(self, where: np.ndarray, value: np.ndarray) -> np.ndarray:
        if not len(self.cells):
            return np.zeros(len(where))
        at = np.minimum(np.searchsorted(self.cells, where), len(self.cells) - 1)
        return np.where(self.cells[at] == where, value * self.weights[at], 0.0)

    def severity(self, text: str) -> float:
        return float(self.above(text).sum())

    def severities(self, rows: Rows) -> np.ndarray:
        raw = np.bincount(rows.row(), self._raw(rows.cells, rows.values), minlength=len(rows))
        return _sigmoid(raw[:, None] - self.thresholds).sum(axis=1)


@dataclass
class Rows:
    """The features of several texts, one text after the other: how many each has, their cells and their values."""

    size: np.ndarray
    cells: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(texts: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        flat = [np.concatenate([np.zeros(0, kind), *(t[k] for t in texts)]) for k, kind in ((0, np.int32), (1, np.float32))]
        return Rows(np.array([len(w) for w, _ in texts], np.int64), *flat)

    def __len__(self) -> int:
        return len(self.size)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.size)), self.size)

    def where(self, texts: np.ndarray) -> Rows:
        keep = np.repeat(texts, self.size)
        return Rows(self.size[texts], self.cells[keep], self.values[keep])

    def having(self, known: np.ndarray) -> Rows:
        """Only the features that ``known`` marks, by cell."""
        keep = known[self.cells]
        return Rows(np.bincount(self.row()[keep], minlength=len(self)), self.cells[keep], self.values[keep])


def _alone(rows: Rows) -> np.ndarray:
    """One over the number of texts that share two minima over their words' hashes: near copies weigh as one text."""
    where = rows.cells.astype(np.uint64)
    keys = []
    for hashed in (where * np.uint64(0x9E3779B97F4A7C15), (where + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)):
        least = np.full(len(rows), 2**64 - 1, np.uint64)
        np.minimum.at(least, rows.row(), hashed)
        keys.append(least)
    _, which, many = np.unique(np.stack(keys, axis=1), axis=0, return_inverse=True, return_counts=True)
    return 1.0 / many[which.ravel()]


def fit(rows: Rows, grades: np.ndarray, weight: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS):
    """Weights (none below 0) per cell and thresholds for grades 0, 1, ...; also the raw scores of the rows.

    Classes weigh the same, texts within one by ``weight``. Accelerated proximal gradient on the summed log loss of the
    boundaries.
    """
    held = [np.bincount(rows.cells, (weight * side)[rows.row()], minlength=CELLS) for side in (grades > 0, grades == 0)]
    total = [max(float(weight[side].sum()), 1e-9) for side in (grades > 0, grades == 0)]
    often = held[0] + held[1] >= min(RARE, max(1, len(rows) // 100)) - 1e-9
    rows = rows.having(often & (held[0] / total[0] >= LIFT * held[1] / total[1]))
    row, value = rows.row(), rows.values.astype(float)
    cells, index = np.unique(rows.cells, return_inverse=True)
    top = int(grades.max(initial=0))
    share = np.bincount(grades, weight, minlength=top + 1)[grades]
    importance = weight / np.maximum(share, 1e-9) / max(len(set(grades.tolist())), 1)
    over = grades[:, None] > np.arange(max(top, 1))
    n, m = len(rows), len(cells)
    w, cut = np.zeros(m), np.zeros(max(top, 1))
    # Power steps give the largest curvature, and so a step size that cannot diverge.
    v = np.ones(m)
    curvature = 1.0
    for _ in range(15):
        u = np.bincount(row, value * v[index], minlength=n) * importance
        v = np.bincount(index, value * u[row], minlength=m)
        curvature = float(np.linalg.norm(v)) or 1.0
        v /= curvature
    rate = 1.0 / (0.3 * curvature * max(top, 1) + 1e-9)
    ahead, ahead_cut, pace = w.copy(), cut.copy(), 1.0
    for _ in range(rounds):
        raw = np.bincount(row, value * ahead[index], minlength=n)
        error = (_sigmoid(raw[:, None] - ahead_cut) - over) * importance[:, None]
        slope = np.bincount(index, value * error.sum(axis=1)[row], minlength=m)
        new = ahead - rate * slope
        new = np.maximum(new - rate * penalty, 0.0)
        new_cut = np.sort(ahead_cut + min(rate, 2.0) * error.sum(axis=0))
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / faster * (new - w)
        ahead_cut = new_cut + (pace - 1) / faster * (new_cut - cut)
        w, cut, pace = new, new_cut, faster
    raw = np.bincount(row, value * w[index], minlength=n)
    used = np.flatnonzero(w)
    return cells[used], w[used], np.sort(cut), raw


def _graded(rows: Rows, toxic: np.ndarray, weight: np.ndarray) -> OrdinalModel:
    """A first fit ranks the toxic texts, the upper half gets the higher grade, and a second fit learns the grades."""
    *_, raw = fit(rows, toxic, weight)
    middle = np.median(raw[(toxic == 1) & (raw > 0)]) if (raw[toxic == 1] > 0).any() else 0.0
    grades = toxic + ((toxic == 1) & (raw > middle))
    cells, weights, thresholds, _ = fit(rows, grades, weight)
    if len(thresholds) < 2:
        thresholds = np.r_[thresholds, thresholds[-1] + 30.0]
    return OrdinalModel(cells, weights, thresholds)


def best_cut(severity: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """Of the cuts that reject at most REJECTED of the clean texts, the one that does least harm.

    A cut lies between neighbouring severities, or above all of them.
    """
    order = np.argsort(-severity, kind="stable")
    high = severity[order]
    clean, bad = (np.cumsum((weight * (toxic == k))[order]) / max(weight[toxic == k].sum(), 1e-9) for k in (0, 1))
    gain = bad - WRONGED * clean
    allowed = (clean <= REJECTED) & np.r_[high[1:] != high[:-1], True]
    best = int(np.where(allowed, gain, 0.0).argmax())
    if not allowed[best] or gain[best] <= 0:
        return float(high[0]) + 1e-3
    return float((high[best] + (high[best + 1] if best + 1 < len(high) else 0.0)) / 2)


def train_model(rows: Rows, toxic: np.ndarray) -> OrdinalModel:
    """The ordinal fit, and the cut that suits what models of the other folds say of each text."""
    toxic = toxic.astype(int)
    if not len(toxic) or toxic.min() == toxic.max():  # nothing to tell apart
        far = 30.0 if not toxic.any() else -30.0
        return OrdinalModel(np.zeros(0, np.int32), np.zeros(0), np.array([far, far]), 1.0)
    weight = _alone(rows)
    model = _graded(rows, toxic, weight)
    fold = np.arange(len(toxic)) % FOLDS
    severity = np.zeros(len(toxic))
    for k in range(FOLDS):
        out = fold == k
        if toxic[~out].min() < toxic[~out].max():
            severity[out] = _graded(rows.where(~out), toxic[~out], weight[~out]).severities(rows.where(out))
    model.cut = best_cut(severity, toxic, weight)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE) -> OrdinalModel:
    """The model for ``labels[label]`` (0 or 1), from rows outside fold 0 of 5. The driver gets features of the sample only."""

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x.as_py()) for x in batch.column("text")]
            cols = [batch.column("doc_id"), batch.column("label"), pa.array([w for w, _ in found], pa.list_(pa.int32()))]
            cols.append(pa.array([v for _, v in found], pa.list_(pa.float32())))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "label", "cells", "counts"])

    rows = labelled_sample(docs, labels, label, ~in_fold(F.col("doc_id"), 5, 0), per_class)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "label")
    found = rows.mapInArrow(sparse, "doc_id long, label int, cells array<int>, counts array<float>").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    lists = [np.array(found[c].combine_chunks().flatten()) for c in ("cells", "counts")]
    return train_model(Rows(np.array(pc.list_value_length(found["cells"]), np.int64), *lists), np.array(found["label"]))


def scorer(model: OrdinalModel) -> Callable[[Column], Column]:
    kind = StructType([StructField("severity", DoubleType()), StructField("score", DoubleType())])

    @F.pandas_udf(kind)
    def score(texts: pd.Series) -> pd.DataFrame:
        above = np.array([model.above(t) for t in texts]).reshape(len(texts), -1)
        return pd.DataFrame({"severity": above.sum(axis=1), "score": above[:, 0]})

    return score


def with_severity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``docs`` with ``severity`` (the expected grade, 0 to 2), ``score`` (the probability of any toxic grade), ``grade``
    (the severity rounded) and ``predicted`` (1: rejected). Null text counts as empty; rows repeat as given.
    """
    docs = without(docs, *OUTPUTS)
    own = unused(docs, "scored")
    found = docs.withColumn(own, scorer(model)(whole_text()))
    return (
        found.withColumn("severity", F.col(f"{own}.severity"))
        .withColumn("score", F.col(f"{own}.score"))
        .withColumn("grade", F.round("severity").cast("int"))
        .withColumn("predicted", (F.col("severity") >= model.cut).cast("int"))
        .drop(own)
    )


def accepted(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows that the model does not reject, with the columns given."""
    return docs.where(scorer(model)(whole_text())["severity"] < model.cut)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = docs.withColumn("held_out", in_fold(F.col("doc_id"), 5, 0))
    return with_severity(held, model).select("doc_id", "held_out", "severity", "score", "grade", "predicted")

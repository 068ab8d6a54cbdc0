"""Quality by a byte-level convolutional network in numpy.

Bytes are embedded; learned filters slide over 8-byte windows every 4 bytes, and over 64-byte stretches of a channel that says
whether the 8 bytes at a place stood there already within the 64 bytes before (byte filters alone cannot see repetition). The
largest answer of each filter over the whole text is kept, and one logistic unit combines them. Texts are read in overlapping
chunks, so no window is lost and a text of any length takes the memory of one chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tagloom.llm.common import table, whole_text, without

#: Learned from at most so many labelled texts of each class, of at most so many characters, the least by a hash of their id.
SAMPLE, SAMPLE_CHARS = 1200, 200_000
EPOCHS, BATCH, RATE = 6, 16, 0.02
THRESHOLD = 0.3

CHUNK = 1 << 16
STEP = 4
WIDTH, DEPTH, FILTERS = 8, 8, 24
LAGS, SPAN, REPEAT_FILTERS = 64, 16, 8
#: Bytes that a chunk shares with the next: whatever a window reads before and after its place.
OVERLAP = LAGS + SPAN * STEP + WIDTH


def _chunks(text: str) -> Iterator[np.ndarray]:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    data = np.concatenate([data, np.zeros(WIDTH + STEP, np.uint8)])
    yield data[:CHUNK]
    for at in range(CHUNK - OVERLAP, len(data) - OVERLAP, CHUNK - OVERLAP):
        yield data[at : at + CHUNK]


def _repeats(data: np.ndarray) -> np.ndarray:
    """At every STEP bytes: 1 if the 8 bytes there are found again 2 to LAGS bytes before."""
    words = np.ndarray(len(data) - 7, "<u8", data.tobytes(), strides=(1,))
    places = np.arange(0, len(words), STEP)
    here = words[places]
    seen = np.zeros(len(places), bool)
    for lag in range(2, LAGS + 1):
        first = -(-lag // STEP)
        seen[first:] |= here[first:] == words[places[first:] - lag]
    return (seen & (here != 0)).astype(np.float32)


class Network:
    """Weights and what they make of texts."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.weights = {
            "bytes": draw(256, DEPTH, scale=0.5),
            "filters": draw(WIDTH * DEPTH, FILTERS, scale=0.2),
            "filter_bias": np.zeros(FILTERS, np.float32),
            "repeats": draw(SPAN, REPEAT_FILTERS, scale=0.1),
            "repeat_bias": np.zeros(REPEAT_FILTERS, np.float32),
            "out": draw(FILTERS + REPEAT_FILTERS, scale=0.2),
            "out_bias": np.zeros(1, np.float32),
        }

    def _answers(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows and filter answers of both kinds, over one chunk."""
        w = self.weights
        n = (len(data) - WIDTH) // STEP + 1
        places = STEP * np.arange(n)[:, None] + np.arange(WIDTH)
        windows = data[places]
        first = w["bytes"][windows].reshape(n, -1) @ w["filters"] + w["filter_bias"]
        seen = np.concatenate([_repeats(data), np.zeros(SPAN, np.float32)])
        spans = np.lib.stride_tricks.sliding_window_view(seen, SPAN)
        return windows, first, spans, spans @ w["repeats"] + w["repeat_bias"]

    def pooled(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The largest answers, and the windows that gave them."""
        best = np.full(FILTERS + REPEAT_FILTERS, -np.inf, np.float32)
        kept, spans_kept = np.zeros((FILTERS, WIDTH), np.uint8), np.zeros((REPEAT_FILTERS, SPAN), np.float32)
        for data in _chunks(text):
            windows, first, spans, second = self._answers(data)
            at, to = first.argmax(axis=0), second.argmax(axis=0)
            top = np.r_[first[at, np.arange(FILTERS)], second[to, np.arange(REPEAT_FILTERS)]]
            better = top > best
            kept[better[:FILTERS]] = windows[at[better[:FILTERS]]]
            spans_kept[better[FILTERS:]] = spans[to[better[FILTERS:]]]
            best = np.maximum(best, top)
        return np.maximum(best, 0.0), kept, spans_kept

    def score(self, text: str) -> float:
        z = float(self.pooled(text)[0] @ self.weights["out"] + self.weights["out_bias"][0])
        return 1.0 / (1.0 + np.exp(-min(max(z, -30.0), 30.0)))

    def _gradient(self, text: str, label: float, into: dict[str, np.ndarray]) -> None:
        w = self.weights
        top, windows, spans = self.pooled(text)
        z = float(top @ w["out"] + w["out_bias"][0])
        error = 1.0 / (1.0 + np.exp(-min(max(z, -30.0), 30.0))) - label
        into["out"] += error * top
        into["out_bias"] += error
        back = error * w["out"] * (top > 0)
        one, two = back[:FILTERS], back[FILTERS:]
        embedded = w["bytes"][windows].reshape(FILTERS, -1)
        into["filters"] += embedded.T * one
        into["filter_bias"] += one
        np.add.at(into["bytes"], windows, (w["filters"].T * one[:, None]).reshape(FILTERS, WIDTH, DEPTH))
        into["repeats"] += spans.T * two
        into["repeat_bias"] += two

    def fit(self, texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
        """Adam on the log loss, both classes weighing the same."""
        rng = np.random.default_rng(seed)
        y = np.array(labels, float)
        weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, steps = 0, max(1, epochs * -(-len(texts) // BATCH))
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                total = {k: np.zeros_like(v) for k, v in self.weights.items()}
                for i in order[at : at + BATCH]:
                    one = {k: np.zeros_like(v) for k, v in self.weights.items()}
                    self._gradient(texts[i], y[i], one)
                    for k in total:
                        total[k] += np.float32(weight[i] / BATCH) * one[k]
                step += 1
                rate = RATE * (1 - step / (steps + 1))
                for k, v in self.weights.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * total[k]
                    square[k] = 0.99 * square[k] + 0.01 * total[k] ** 2
                    v -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's digits leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int = SAMPLE, most_chars: int = SAMPLE_CHARS) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most ``per_class`` labelled texts per class, chosen by a hash of the id.

    The choice looks at labels alone; its few ids are broadcast to the documents. Null texts and longer texts are passed over.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & allowed).select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("label") == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    few = chosen[0].unionByName(chosen[1])
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= most_chars))
    return texts.join(F.broadcast(few), "doc_id")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE) -> Network:
    """The network for ``labels[label]``, from rows outside fold 0 of 5."""
    rows = labelled_sample(docs, labels, label, ~in_fold(F.col("doc_id"), 5, 0), per_class).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return Network().fit([r["text"] for r in rows], [r["label"] for r in rows])


def scorer(network: Network) -> Callable[[Column], Column]:
    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(network.score)

    return score


def with_scores(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on); null text counts as empty."""
    docs = without(docs, "score", "predicted")
    return docs.withColumn("score", scorer(network)(whole_text())).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = train(docs, table(spark, sf_dir, "labels"))
    held = docs.withColumn("held_out", in_fold(F.col("doc_id"), 5, 0))
    return with_scores(held, network).select("doc_id", "held_out", "score", "predicted")

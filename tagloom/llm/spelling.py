"""Spelling variants by finite-state composition.

The minimised acceptor of the vocabulary is composed with a one-edit transducer and with the acceptor again; each word pair the
composition accepts differs by one inserted, deleted or replaced letter. The work is dealt by initial state: the state that a
word's first half leads to (or, in acceptors of the reversed words, its last half). For a pair whose shorter word has ``m``
letters, the first difference either comes after the first ``m // 2`` letters, and both words pass through that state, or
before, and the reversed words share the state of the rest. So every pair is accepted from exactly one initial state.

An initial state with too many words behind it is moved on along its arcs, and the edits at the state itself are enumerated
apart, one group for each rest of a word: no group is too large for a task, whatever words share.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored, whole_text

LETTERS, LEAST, RATIO = 5, 3, 2
#: Of the runs, those whose hash this divides lose a letter.
ONE_IN = 97
#: Words behind an initial state that one task composes.
LIMIT = 20_000
#: Text characters searched for words at a time, and words held before their counts are handed on.
STRETCH, HELD = 1 << 20, 200_000

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LETTERS)
_LETTER = re.compile("[A-Za-zÀ-ÿ]")


def _stretches(text: str) -> Iterator[str]:
    """Parts of a text that do not cut a run."""
    at = 0
    while at < len(text):
        stop = min(at + STRETCH, len(text))
        while stop < len(text) and _LETTER.match(text[stop]) and _LETTER.match(text[stop - 1]):
            stop += 1
        yield text[at:stop]
        at = stop


def words_of(doc_id: str, text: str) -> dict[str, int]:
    """The words of a text with their counts; runs whose hash ONE_IN divides have lost a letter."""
    runs: Counter[str] = Counter()
    for part in _stretches(text):
        runs.update(_RUN.findall(part.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    begun = zlib.crc32(f"{doc_id}:".encode())
    out: dict[str, int] = {}
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), begun)
        if not h % ONE_IN:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) < LETTERS:
                continue
        out[run] = out.get(run, 0) + n
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, int] = {}
    out = lambda: pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            for word, n in words_of(doc_id.as_py(), text.as_py()).items():
                total[word] = total.get(word, 0) + n
            if len(total) >= HELD:
                yield out()
                total = {}
    yield out()


def vocabulary(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``word`` and ``n``: words of LETTERS letters or more that occur at least ``least`` times. A null id counts as empty."""
    given = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), whole_text().alias("text"))
    counts = given.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


class Acceptor:
    """The minimal deterministic acceptor of sorted, distinct words."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        path: list[tuple[str, dict[str, int], bool]] = [("", {}, False)]  # the states of the last word, not yet registered
        last = ""
        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            self._register(path, common)
            path += [(letter, {}, False) for letter in word[common:]]
            path[-1] = (path[-1][0], path[-1][1], True)
            last = word
        self._register(path, 0)
        self.start = self._state(path[0])

    def _register(self, path: list, keep: int) -> None:
        while len(path) > keep + 1:
            state = path.pop()
            path[-1][1][state[0]] = self._state(state)

    def _state(self, state: tuple[str, dict[str, int], bool]) -> int:
        key = (state[2], *state[1].items())
        if key not in self.known:
            self.known[key] = len(self.arcs)
            self.arcs.append(state[1])
            self.final.append(state[2])
        return self.known[key]

    def composed(self, short: int, only_first: bool = False) -> Iterator[tuple[str, str]]:
        """Accepted pairs, one edit apart: both of ``short`` letters, or the second with one more.

        The edit comes where the two words first differ; with ``only_first`` at the first letter.
        """
        dead: set[tuple[int, int]] = set()
        path: list[str] = []
        todo = [(self.start, 0, "")]
        while todo:
            state, depth, letter = todo.pop()
            del path[max(depth - 1, 0) :]
            if letter:
                path.append(letter)
            arcs = list(self.arcs[state].items())
            begun = "".join(path) if len(arcs) > 1 or self.final[state] else None
            for k, (a, one) in enumerate(arcs):
                for b, two in arcs[k + 1 :]:
                    for rest in self._both(one, two, "", dead, short - depth - 1):
                        yield begun + a + rest, begun + b + rest
            for b, two in arcs:  # b is inserted before a rest that does not begin with it
                for rest in self._both(state, two, b, dead, short - depth):
                    yield "".join(path) + rest, "".join(path) + b + rest
            if not only_first:
                todo += [(to, depth + 1, b) for b, to in arcs]

    def _both(self, one: int, two: int, barred: str, dead: set[tuple[int, int]], size: int) -> list[str]:
        """What both states accept of so many letters, without what begins with the letter ``barred``."""
        if (one, two) in dead:
            return []
        out: list[str] = []
        seen = any_cut = False
        path: list[str] = []
        todo = [(one, two, 0, "")]
        reached: list[tuple[int, int]] = []
        while todo:
            x, y, depth, letter = todo.pop()
            del path[max(depth - 1, 0) :]
            if letter:
                path.append(letter)
            reached.append((x, y))
            if self.final[x] and self.final[y]:
                seen = True
                if depth == size:
                    out.append("".join(path))
            if depth < size:
                here, there = self.arcs[x], self.arcs[y]
                if len(there) < len(here):
                    common = [b for b in there if b in here]
                else:
                    common = [b for b in here if b in there]
                for b in common:
                    if depth == 0 and b == barred:
                        any_cut = True
                    elif (here[b], there[b]) not in dead:
                        todo.append((here[b], there[b], depth + 1, b))
            elif self.arcs[x] and self.arcs[y]:
                any_cut = True
        if not seen and not any_cut:
            dead.update(reached)
        return out


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the groups, which come whole and in order: each word's near words, how many and the best (as -n and word)."""
    names = ["m", "back", "size", "only", "state", "spelled", "n"]

    def composed(key: tuple, group: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
        m, back, size, only, _ = key
        begun = group[0][0][:size]
        counts = {spelled[size:]: n for spelled, n in group}
        half = m // 2
        found: dict[str, list] = {}
        for one, two in Acceptor(sorted(counts)).composed(m - size, only):
            a, b = begun + one, begun + two
            if back:
                a, b = a[::-1], b[::-1]
                if a[:half] == b[:half]:  # accepted from the state of their common beginning
                    continue
            for x, y, n in ((a, b, counts[two]), (b, a, counts[one])):
                best = found.setdefault(x, [0, 1, ""])
                best[0] += 1
                if (-n, y) < (best[1], best[2]):
                    best[1:] = -n, y
        for word, best in found.items():
            yield word, *best

    def rows(groups: list[tuple[tuple, list]]) -> pa.RecordBatch:
        out = [row for key, group in groups for row in composed(key, group)]
        cols = list(zip(*out)) if out else [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["word", "near", "less", "form"])

    last, group = None, []
    for batch in batches:
        whole = []
        cols = [batch.column(c).to_pylist() for c in names]
        for *key, spelled, n in zip(*cols):
            key = tuple(key)
            if key != last:
                if len(group) > 1:
                    whole.append((last, group))
                last, group = key, []
            group.append((spelled, n))
        if whole:
            yield rows(whole)
    if len(group) > 1:
        yield rows([(last, group)])


_KEYS = ["m", "back", "size", "only", "state"]


def _dealt(words: DataFrame) -> DataFrame:
    """Each word under the initial states it passes: of its length, and of one less for pairs with a shorter word."""
    size = F.length("word")
    kinds = []
    for less in (0, 1):
        m = size - less
        half = F.floor(m / 2).cast("int")
        for back, kept, spelled in ((False, half, F.col("word")), (True, m - half, F.reverse("word"))):
            one = F.struct(m.alias("m"), F.lit(back).alias("back"), kept.alias("size"), spelled.alias("spelled"))
            kinds.append(F.when(m >= LETTERS, one))
    each = words.select("n", F.explode(F.array_compact(F.array(*kinds))).alias("e")).select("n", "e.*")
    return each.withColumn("only", F.lit(False)).withColumn("state", F.substring("spelled", F.lit(1), F.col("size")))


def _moved_on(rows: DataFrame) -> DataFrame:
    """Rows of too large groups: under the next state of each word, and under the rest that follows an edit at this state."""
    after = lambda skip: F.col("spelled").substr(F.col("size") + 1 + skip, F.length("spelled"))
    mark = lambda kind, rest: F.concat("state", F.lit(f" {kind} "), rest)  # noqa: E731  a space is no letter
    short = F.length("spelled") == F.col("m")
    on = F.struct((F.col("size") + 1).alias("size"), F.lit(False).alias("only"), F.substring("spelled", F.lit(1), F.col("size") + 1).alias("state"))
    replaced = F.struct("size", F.lit(True).alias("only"), mark("r", after(F.lit(1))).alias("state"))
    inserted = F.struct("size", F.lit(True).alias("only"), mark("i", F.when(short, after(F.lit(0))).otherwise(after(F.lit(1)))).alias("state"))
    kinds = F.array_compact(F.array(F.when(F.col("size") < F.length("spelled"), on), F.when(short & (F.col("size") < F.col("m")), replaced), inserted))
    return rows.select("m", "back", "spelled", "n", F.explode(kinds).alias("e")).select("n", "m", "back", "e.size", "spelled", "e.only", "e.state")


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word``, ``n_near``, ``less`` and ``form`` (-n and spelling of the best) of the words that have a near word."""
    columns = ["m", "back", "size", "only", "state", "spelled", "n"]
    todo, parts = _dealt(words), []
    while True:
        hot = todo.where("NOT only").groupBy(*_KEYS).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit).select(*_KEYS)
        hot = stored(hot, "spelling-hot")
        if not hot.take(1):
            parts.append(todo)
            break
        parts.append(todo.join(hot, _KEYS, "left_anti"))
        todo = stored(_moved_on(todo.join(hot, _KEYS, "left_semi")), "spelling-moved")
    rows = parts[0].select(*columns)
    for part in parts[1:]:
        rows = rows.union(part.select(*columns))
    ordered = rows.repartition(*(F.col(k) for k in _KEYS)).sortWithinPartitions(*_KEYS)
    found = ordered.mapInArrow(_near, "word string, near long, less long, form string")
    best = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    return best.select("word", "n_near", "best.less", "best.form")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form, of the words that have one; each round doubles the steps that are followed."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        on = now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        on = stored(on, "spelling-roots")
        now = on.select("word", "root")
        if not on.where("moved").take(1):
            return now


def variants(docs: DataFrame, least: int = LEAST, ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the texts.

    A word's form is its near word of largest ``n`` (ties: the first by code points) if that is at least ``ratio`` times the
    word's own, else null; its root is where following forms ends. Null text has no words, a null id counts as the empty
    string, repeated rows count each time. Empty input gives no rows.
    """
    words = stored(vocabulary(docs, least), "vocabulary")
    near = stored(near_words(words, limit), "near-words")
    formed = words.join(near, "word", "left")
    far = F.coalesce(-F.col("less") >= ratio * F.col("n"), F.lit(False))
    formed = formed.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(far, F.col("form")).alias("form"), F.when(far, -F.col("less")).alias("form_n"))
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(docs).select("word", "form", "root", "n", "n_near", "form_n")

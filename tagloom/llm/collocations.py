"""Phrase collocations by Rabin-Karp fingerprints.

A text's words are written one after the other, a space between neighbours of a piece. One running sum over these bytes, each
times a power of an odd factor, gives the polynomial fingerprint of every run of words as a difference of two of its values
(modulo 2^64, times the inverse power at the start), so all runs of a stretch are hashed at once.

Fingerprints of pairs are counted first; the frequent ones leave their marks in a map of fixed size. Only triples both of whose
pairs are marked are counted next, and marked likewise. A last pass reads the occurrences of marked fingerprints from the texts
and counts them by their words: fingerprints that collide are told apart there, marks that rare phrases share do no harm, and
only frequent phrases are ever materialised. The phrases of the result get a pointer to a document they stand in, found by their
fingerprints likewise.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import gathered, stored, whole_text

LEAST = 10
TOP = 2000
#: A part of a longer phrase that is at least so many per cent as frequent is dropped.
COVERED = 50
SCALE = 1_000_000
#: Marks of frequent fingerprints: so many bits, whatever the input. More frequent phrases only mean more false marks.
MARKS = 1 << 27
#: Bytes hashed at a time. A longer text is cut between words.
STRETCH = 1 << 20
#: Salts of the first ranking, which leaves at most so many times TOP rows of a language for the second.
SALTS = 16

_FACTOR = 0x5851F42D4C957F2D  # odd
_PIECE_ENDS = np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)
_KINDS = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KINDS[[0x20, 0x09]] = 1
_KINDS[_PIECE_ENDS] = 2
#: What stands for each byte in the sum.
_VALUES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=2)
def _table(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _powers(factor: int, n: int) -> np.ndarray:
    """The first ``n`` powers, from a table that is kept for stretches and made anew for a word longer than one."""
    return _table(factor, 2 * STRETCH if n <= 2 * STRETCH else 1 << n.bit_length())[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words begin and end, and the number of each one's piece."""
    edge = np.diff(np.r_[np.int8(0), (kinds == 0).view(np.int8), np.int8(0)])
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return begin, end, np.cumsum(kinds == 2, dtype=np.int32)[begin] if len(begin) else begin


def cut(text: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """Parts of about ``size`` bytes, cut between words, and how many words of each the part before it ends with.

    Within a piece two words are repeated, so that no run of three is lost.
    """
    if len(text) <= size:
        yield text, 0
        return
    begin, end, piece = _words(_KINDS[np.frombuffer(text, np.uint8)])
    first = new = 0
    while new < len(begin):
        last = max(new, int(np.searchsorted(end, begin[first] + size, "right")) - 1)
        yield text[begin[first] : end[last]], new - first
        new = first = last + 1
        while first < len(begin) and new - first < 2 and first and piece[first - 1] == piece[new]:
            first -= 1


class Words:
    """The words of several texts: where each begins and ends in ``data``, its piece and its text, and whether it is new."""

    def __init__(self, parts: list[tuple[bytes, int, int]]):
        """``parts``: bytes, words repeated at the beginning, number of the text."""
        raw = np.frombuffer(b"\n".join(p[0] for p in parts), np.uint8)
        kinds = _KINDS[raw]
        begin, end, self.piece = _words(kinds)
        part_begin = np.cumsum([0, *(len(p[0]) + 1 for p in parts[:-1])])
        part = np.searchsorted(part_begin, begin, "right") - 1
        repeated, text = (np.array([p[k] for p in parts], np.int64) for k in (1, 2))
        self.new = np.arange(len(begin)) - np.searchsorted(begin, part_begin)[part] >= repeated[part]
        self.text = text[part]
        # Written one after the other, a space after each.
        self.end = np.cumsum(end - begin + 1) - 1
        self.begin = self.end - (end - begin)
        self.data = np.full(int(self.end[-1]) + 1 if len(begin) else 0, 0x20, np.uint8)
        letters = np.ones(len(self.data), bool)
        letters[self.end] = False
        self.data[letters] = raw[kinds == 0]

    def runs(self, order: int) -> np.ndarray:
        """The first words of all runs of ``order`` words within a piece, those wholly repeated from another part left out."""
        n = len(self.begin) - order + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero((self.piece[:n] == self.piece[order - 1 :]) & self.new[order - 1 :])

    @functools.cached_property
    def sums(self) -> np.ndarray:
        return np.r_[np.uint64(0), np.cumsum(_VALUES[self.data] * _powers(_FACTOR, len(self.data)), dtype=np.uint64)]

    def prints(self, first: np.ndarray, order: int, salt: np.ndarray) -> np.ndarray:
        """Fingerprints of runs; ``salt`` (by text) tells languages apart."""
        s, e = self.begin[first], self.end[first + order - 1]
        back = _powers(pow(_FACTOR, -1, 1 << 64), len(self.data))
        own = salt[self.text[first]] + np.uint64(order)
        return _mixed((self.sums[e] - self.sums[s]) * back[s] ^ own)

    def phrases(self, first: np.ndarray, order: int) -> pa.Array:
        """The runs themselves."""
        s, size = self.begin[first], self.end[first + order - 1] - self.begin[first]
        ends = np.cumsum(size)
        data = self.data[np.repeat(s - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        offsets = np.r_[0, ends].astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def marked(marks: np.ndarray, prints: np.ndarray) -> np.ndarray:
    cell = prints & np.uint64(64 * len(marks) - 1)
    return (marks[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) != 0


def _stretches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Words, pa.Table, np.ndarray]]:
    """The words of the rows, about ``size`` bytes at a time, the rows, and a salt for each row's language."""
    for rows in gathered(batches, size):
        of = {x: xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 3) for x in set(rows["lang"].to_pylist())}
        salt = np.array([of[x] for x in rows["lang"].to_pylist()], np.uint64)
        parts, held = [], 0
        for number, text in enumerate(rows["text"]):
            for part, repeated in cut(text.as_py().encode("utf-8", "surrogatepass").lower(), size):
                parts.append((part, repeated, number))
                held += len(part)
                if held >= size:
                    yield Words(parts), rows, salt
                    parts, held = [], 0
        if parts:
            yield Words(parts), rows, salt


def _counted(order: int, marks: Broadcast | None, size: int):
    """Fingerprints of all runs of so many words, with counts; with ``marks``, of those whose shorter runs are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _, salt in _stretches(batches, size):
            first = words.runs(order)
            for at in range(order - 1) if marks else ():
                first = first[marked(marks.value, words.prints(first + at, order - 1, salt))]
            prints, n = np.unique(words.prints(first, order, salt), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(n)], ["print", "n"])

    return run


def _read(marks: list[Broadcast], size: int, pointers: bool = False):
    """All words, and the marked pairs and triples, by their text: language, line break, phrase, with counts.

    With ``pointers``: the pairs and triples only, with the least id of the documents they stand in.
    """
    none = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, rows, salt in _stretches(batches, size):
            langs = rows["lang"].combine_chunks().dictionary_encode()
            langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
            lang = langs.indices.to_numpy()
            for order in (2, 3) if pointers else (1, 2, 3):
                first = words.runs(order)
                for k in range(2, order + 1):
                    for at in range(order - k + 1):
                        first = first[marked(marks[k - 2].value, words.prints(first + at, k, salt))]
                found = words.phrases(first, order).dictionary_encode()
                key = lang[words.text[first]].astype(np.int64) * max(len(found.dictionary), 1) + found.indices.to_numpy()
                _, one, same, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                phrases = found.take(pa.array(one)).cast(pa.large_binary()).cast(pa.large_string()).cast(pa.string())
                name = langs.dictionary.take(pa.array(lang[words.text[first[one]]])).cast(pa.string())
                names = pc.binary_join_element_wise(name, phrases, "\n")
                if pointers:
                    n = np.full(len(one), none)
                    np.minimum.at(n, same, rows["doc_id"].fill_null(none).to_numpy()[words.text[first]])
                yield pa.RecordBatch.from_arrays([names, pa.array(n, mask=n == none)], ["name", "n"])

    return run


def _marks(prints: DataFrame, least: int, bits: int) -> np.ndarray:
    """The map of the fingerprints that occur often enough, so many bits: the driver gets its words, at most bits / 64 rows."""
    often = prints.groupBy("print").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    cell = F.col("print").bitwiseAND(bits - 1)
    bit = F.expr("shiftleft(1L, cast(cell & 63 AS int))")
    words = often.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _given(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), whole_text().alias("text")).where("text <> ''")


def _all_marks(texts: DataFrame, least: int, bits: int, size: int) -> list[Broadcast]:
    """Marks of the pairs, and of the triples of such pairs."""
    marks: list[Broadcast] = []
    for order in (2, 3):
        prints = texts.select("lang", "text").mapInArrow(_counted(order, marks[-1] if marks else None, size), "print long, n long")
        marks.append(texts.sparkSession.sparkContext.broadcast(_marks(prints, least, bits)))
    return marks


def _named(rows: DataFrame) -> DataFrame:
    """``lang`` and ``phrase`` from ``name``: no phrase holds a line break, a language may."""
    phrase = F.substring_index("name", "\n", -1)
    lang = F.col("name").substr(F.lit(1), F.length("name") - F.length(phrase) - 1)
    return rows.select(lang.alias("lang"), phrase.alias("phrase"), *(c for c in rows.columns if c != "name"))


def phrases(docs: DataFrame, least: int = LEAST, bits: int = MARKS, size: int = STRETCH) -> DataFrame:
    """``lang``, ``words`` (1 to 3), ``phrase`` and ``n`` (occurrences).

    Every word, and the runs of two and three words within a piece that occur at least ``least`` times in their language
    (null: ``und``). A-Z are lower-cased; null text counts as empty. Repeated rows count each time.
    """
    texts = _given(docs)
    rows = texts.mapInArrow(_read(_all_marks(texts, least, bits, size), size), "name string, n long")
    found = _named(rows.groupBy("name").agg(F.sum("n").alias("n"))).withColumn("words", F.size(F.split("phrase", " ")))
    return found.where((F.col("words") == 1) | (F.col("n") >= least))


def pointed(docs: DataFrame, some: DataFrame, bits: int = MARKS, size: int = STRETCH) -> DataFrame:
    """``some`` (``lang``, ``phrase``, ...) with ``doc_id``, the least id of the documents that hold the phrase (null: none)."""
    marks = _all_marks(some.select("lang", F.col("phrase").alias("text")), 1, bits, size)
    rows = _given(docs).mapInArrow(_read(marks, size, True), "name string, n long")
    found = _named(rows.groupBy("name").agg(F.min("n").alias("doc_id")))
    return some.join(found, ["lang", "phrase"], "left")


def _first(ranked: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language, with ``rank``; ranked in salted parts first, so no language is one task's work."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    few = ranked.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    last = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return last.where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of two and three words of each language: ``lang``, ``rank``, ``phrase``, ``a`` (its occurrences),
    ``l`` and ``r`` (those of the parts of its weakest cut), ``n`` (words of the language), ``score`` and ``doc_id``.

    A cut scores SCALE * a * a / (l * r), rounded down; the least of a phrase's cuts counts, the earliest of equal ones. Phrases
    within a longer one that is at least COVERED per cent as frequent are left out. Ties go by ``a``, then by the phrase's bytes.
    Empty input gives no rows.
    """
    found = stored(phrases(docs, least), "phrases")
    total = found.where("words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    often = found.where(F.col("n") >= least)
    word = F.split("phrase", " ")
    part = lambda at, size: F.array_join(F.slice(word, at, size), " ")
    many = often.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    inside = many.where("words = 3").select("lang", "a", F.explode(F.array(part(1, 2), part(2, 2))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    many = many.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < COVERED * F.col("a"), F.lit(True)))
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"), part(F.lit(1), k).alias("left"), part(k + 1, F.col("words") - k).alias("right")),
    )
    # From here on the two parts stand for the phrase.
    cut_up = many.select("lang", "a", F.explode(cuts).alias("c")).select("lang", "a", "c.*")
    for side, name in (("left", "l"), ("right", "r")):
        cut_up = cut_up.join(often.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    exact = f"(cast({SCALE} AS decimal(8,0)) * (cast(a AS decimal(15,0)) * cast(a AS decimal(15,0)))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))"
    scored = cut_up.select("lang", "k", F.concat_ws(" ", "left", "right").alias("phrase"), "a", "l", "r", F.expr(exact).alias("score"))
    weakest = F.row_number().over(Window.partitionBy("lang", "phrase").orderBy("score", "k"))
    kept = scored.withColumn("_n", weakest).where("_n = 1")
    best = stored(_first(kept, top).join(total, "lang"), "collocations")
    return pointed(docs, best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text"))


#: The same rows from plain counts of all runs of words.
SQL = """
    WITH listed AS (
        SELECT row_number() OVER () AS p, doc_id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
        FROM (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
            coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)),
    words AS (SELECT p, doc_id, lang, unnest(w) AS w1, unnest(range(len(w))) AS i FROM listed),
    runs AS (
        SELECT lang, doc_id, w1, lead(w1) OVER x AS w2, lead(w1, 2) OVER x AS w3
        FROM words WINDOW x AS (PARTITION BY p ORDER BY i)),
    one AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
    two AS (SELECT lang, w1, w2, count(*) AS f, min(doc_id) AS doc_id FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
    three AS (SELECT lang, w1, w2, w3, count(*) AS f, min(doc_id) AS doc_id FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING f >= 10),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
    cuts AS (
        SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, 1 AS cut, t.f AS a, x.f AS l, y.f AS r, t.doc_id
        FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2 WHERE t.f >= 10
        UNION ALL
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, x.f, y.f, t.doc_id
        FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
             JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
        UNION ALL
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f, t.doc_id
        FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
             JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
    scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    longer AS (
        SELECT lang, phrase, max(f) AS f
        FROM (SELECT lang, f, w1 || ' ' || w2 AS phrase FROM three UNION ALL SELECT lang, f, w2 || ' ' || w3 FROM three) GROUP BY ALL),
    kept AS (
        SELECT s.* FROM weakest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
        WHERE coalesce(100 * g.f < 50 * s.a, true))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, doc_id
    FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

"""Personal data by weak supervision, in DataFrame functions alone.

Base patterns (email, ip, card, phone) always count. Wider patterns give further candidates (long numbers, key-like strings).
Five labelers vote on every candidate: its shape, a validity check, a gazetteer of words before it, the running text around it,
and its borders. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, without any
label; a logistic span classifier is then fitted to the resulting probabilities and decides about the further candidates.

Per document all stays in one row: the candidates are an array, so nothing is shuffled but the counts of vote patterns, of which
there are at most 6 * 3^5. These are all that the driver sees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored, whole_text, without

KINDS = ["email", "ip", "card", "phone", "number", "secret"]
BASE = 4
LABELERS = ["shape", "valid", "gazetteer", "context", "border"]
#: Characters around a candidate that labelers look at.
AROUND = 32
THRESHOLD = 0.5
ROUNDS, STEPS = 50, 400

# The words of the gazetteer.
NEAR = (
    "account address bank call card contact credit email iban id ip key licence login mail mobile number passport password "
    "phone pin secret ssn tel telephone token user visa"
).split()
AGAINST = "chapter figure isbn issn page section table version volume".split()

#: Stands for a separator between two digits while card numbers are looked for; the text's own are blanked before.
JOINT = "\ue000"

_LOCAL = "A-Za-z0-9._%+-"
# A match begins where a run of its characters begins, or where the last match ended: the same matches as without the condition,
# but no run is tried from each of its characters.
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD = f"[0-9][0-9{JOINT}]++"
SECRET = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}+"
_PART = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

OUTPUTS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")

_FOUND = "array<struct<start:int,end:int,m:string,before:string,after:string>>"


def _located(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Adds ``name``: the pattern's leftmost matches that do not overlap, with code-point places and what stands around them."""
    found = df.withColumn("_m", F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    found = found.withColumn("_s", F.when(F.size("_m") > 0, F.split(F.col(text), pattern, -1)))
    found = found.withColumn("_z", F.arrays_zip(F.col("_m").alias("m"), F.slice("_s", 1, F.size("_m")).alias("s"), F.slice("_s", 2, F.size("_m")).alias("t")))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["s"])
        end = start + F.length(x["m"])
        one = F.struct(
            start.alias("start"), end.alias("end"), x["m"].alias("m"), F.right(x["s"], F.lit(AROUND)).alias("before"), F.left(x["t"], F.lit(AROUND)).alias("after")
        )
        return F.struct(end.alias("at"), F.concat(done["all"], F.array(one)).alias("all"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("all"))
    all_ = F.aggregate(F.col("_z"), begin, step, lambda x: x["all"])
    return found.withColumn(name, F.when(F.size("_m") > 0, all_).otherwise(F.array().cast(_FOUND))).drop("_m", "_s", "_z")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits holds."""

    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), lambda total, i: total + worth(i)) % 10 == 0


def _votes(kind: int, x: Column) -> list[Column]:
    """A vote per labeler: 1 personal, 0 not, 2 none."""
    m, before, after = x["m"], x["before"], x["after"]
    digits = _digits(m)
    n = F.length(digits)
    yes, no, none = F.lit(1), F.lit(0), F.lit(2)
    varied = F.size(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: F.substring(m, i, F.lit(1)))))
    shape = [
        yes,
        yes,
        yes,
        yes,
        F.when((n == 9) | n.between(13, 19), yes).when(n >= 20, no).otherwise(none),
        F.when(m.rlike("^[0-9a-f]{32,}$"), yes).otherwise(none),
    ][kind]
    valid = [
        F.when(m.rlike(r"\.[A-Za-z]{2,}$"), yes).otherwise(no),
        F.when(m.rlike(r"^(?:[0-9]\.){3}[0-9]$"), no).otherwise(yes),
        F.when(m.rlike("^[3-6]"), yes).otherwise(none),
        F.when(n.between(11, 13), yes).otherwise(none),
        F.when(varied <= 2, no).otherwise(none),
        F.when(m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (varied >= 8), yes).otherwise(no),
    ][kind]
    words = F.lower(before)
    near = F.when(words.rlike(rf"\b(?:{'|'.join(AGAINST)})\b"), no).when(words.rlike(rf"\b(?:{'|'.join(NEAR)})\b"), yes).otherwise(none)
    running = (before.rlike(r"\p{L}[,;:.!]?\s+$") | (before == "")) & (after.rlike(r"^[,;:.!?]?\s+\p{L}") | (after.rlike(r"^[.!?]?$")))
    assigned = before.rlike(r"""[=:]\s*["']?$""")
    context = F.when(assigned | running, yes).when(before.rlike(r"[0-9]\s*$") & after.rlike(r"^\s*[0-9]"), no).otherwise(none)
    border = F.when(before.rlike(r"""(?:^|[\s"'(<:\[])$""") & after.rlike(r"""^(?:$|[\s"')>,;.!?\]])"""), yes).otherwise(no)
    return [shape, valid, near, context, border]


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``cands``: kind (its number), place, whether it is a base span, and votes, of every candidate of a text."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # A text without a digit has no candidate but emails.
    marked = F.regexp_replace(F.translate("text", JOINT, "x"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    df = df.withColumn("marked", F.when(F.col("text").rlike("[0-9]"), marked).otherwise(""))
    df = _located(df, "text", EMAIL, "email")
    df = _located(df, "text", IP, "ip")
    df = _located(df, "text", PHONE, "phone")
    df = _located(df, "marked", CARD, "run")
    df = _located(df, "text", SECRET, "secret")
    count = lambda x: F.length(_digits(x["m"]))
    card = lambda x: count(x).between(14, 19) & luhn(_digits(x["m"]))
    kept = {
        "email": F.col("email"),
        "ip": F.filter("ip", lambda x: x["m"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        "card": F.filter("run", card),
        "phone": F.filter("phone", lambda x: count(x).between(10, 15)),
        "number": F.filter("run", lambda x: (count(x) >= 7) & ~card(x)),
        "secret": F.filter("secret", lambda x: x["m"].rlike("[0-9]") & x["m"].rlike("[A-Za-z]")),
    }
    df = df.select("doc_id", *(v.alias(k) for k, v in kept.items()))

    def voted(number: int, kind: str) -> Column:
        def one(x: Column) -> Column:
            votes = [v.cast("int").alias(n) for v, n in zip(_votes(number, x), LABELERS, strict=True)]
            return F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"), *votes)

        return F.transform(F.col(kind), one)

    base = df.withColumn("base", F.concat(*(voted(i, k) for i, k in enumerate(KINDS[:BASE]))))
    apart = lambda y: ~F.exists("base", lambda b: (b["start"] < y["end"]) & (y["start"] < b["end"]))
    more = F.filter(F.concat(*(voted(i, k) for i, k in enumerate(KINDS) if i >= BASE)), apart)
    return base.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(more).alias("more"))


def _sigmoid(z: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, z))))


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """The probability of each pattern (kind, votes...) to be personal data, by expectation-maximisation.

    Labelers vote independently given the truth; each has a distribution of votes for either truth, and each kind a share of
    personal data. It begins with the share of 1 among the votes given.
    """
    belief = {}
    for p in patterns:
        given = [v for v in p[1:] if v != 2]
        belief[p] = min(max(sum(given) / len(given) if given else 0.5, 0.05), 0.95)
    for _ in range(rounds):
        prior, emit = {}, {}
        for truth in (0, 1):
            for kind in {p[0] for p in patterns}:
                mine = [(n, belief[p] if truth else 1 - belief[p]) for p, n in patterns.items() if p[0] == kind]
                prior[kind, truth] = (sum(n * b for n, b in mine) + 1) / (sum(n for n, _ in mine) + 2)
            for k in range(len(LABELERS)):
                mass = [1.0, 1.0, 1.0]
                mass[truth] += 2.0  # a labeler is right more often than not
                for p, n in patterns.items():
                    mass[p[k + 1]] += n * (belief[p] if truth else 1 - belief[p])
                emit[k, truth] = [x / sum(mass) for x in mass]
        for p in patterns:
            odds = math.log(prior[p[0], 1] / prior[p[0], 0])
            odds += sum(math.log(emit[k, 1][v] / emit[k, 0][v]) for k, v in enumerate(p[1:]))
            belief[p] = _sigmoid(odds)
    return belief


def _inputs(pattern: tuple[int, ...]) -> list[int]:
    """The places of the classifier's features that a pattern sets: a constant, its kind, and each vote that was given."""
    return [0, 1 + pattern[0], *(1 + len(KINDS) + 2 * k + v for k, v in enumerate(pattern[1:]) if v != 2)]


def span_classifier(patterns: dict[tuple[int, ...], int], belief: dict[tuple[int, ...], float], steps: int = STEPS) -> list[float]:
    """Weights of a logistic regression fitted to the beliefs, patterns weighing by the log of their counts."""
    weights = [0.0] * (1 + len(KINDS) + 2 * len(LABELERS))
    share = {p: math.log1p(n) for p, n in patterns.items()}
    total = sum(share.values()) or 1.0
    for _ in range(steps):
        slope = [1e-4 * w for w in weights]
        for p, n in share.items():
            inputs = _inputs(p)
            error = _sigmoid(sum(weights[i] for i in inputs)) - belief[p]
            for i in inputs:
                slope[i] += n / total * error
        weights = [w - 1.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def probability(weights: list[float], x: Column) -> Column:
    """The classifier's probability of a candidate."""
    kinds = F.array(*(F.lit(w) for w in weights[1 : 1 + len(KINDS)]))
    z = F.lit(weights[0]) + F.element_at(kinds, x["kind"] + 1)
    for k, name in enumerate(LABELERS):
        no, yes = weights[1 + len(KINDS) + 2 * k : 3 + len(KINDS) + 2 * k]
        z = z + F.when(x[name] == 1, F.lit(yes)).when(x[name] == 0, F.lit(no)).otherwise(F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-z))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``found`` (kind, start, end, base, probability; by start, then kind) and the digest columns, per row given.

    Places are code points, ends exclusive. Null text is empty and has no span. A further span that touches a base span is
    dropped. Rows repeat as given; a text of any length is searched whole. Empty input gives no rows.
    """
    known = stored(candidates(without(docs, *OUTPUTS)), "pii")
    seen = known.select(F.explode(F.concat("base", "more")).alias("x")).groupBy("x.kind", *(F.col(f"x.{n}") for n in LABELERS)).count()
    patterns = {tuple(r[: 1 + len(LABELERS)]): r["count"] for r in seen.collect()}  # at most 6 * 3^5
    patterns = dict(sorted(patterns.items()))
    weights = span_classifier(patterns, reliabilities(patterns))
    rated = lambda name, base: F.transform(
        F.col(name), lambda x: F.struct(x["start"], x["kind"], x["end"], F.lit(base).alias("base"), probability(weights, x).alias("probability"))
    )
    more = F.filter(rated("more", False), lambda x: x["probability"] >= threshold)
    all_ = known.withColumn("all", F.array_sort(F.concat(rated("base", True), more)))
    many = lambda number: F.size(F.filter("base", lambda x: x["kind"] == number)).cast("long")
    counts = [many(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE])]
    return all_.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"), F.col("all").alias("found"))


def op10_pii(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("found")

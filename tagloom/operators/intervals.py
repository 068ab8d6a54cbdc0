"""Analytics over irregular intervals: slices, excursions, incidents and
combinations of on/off tags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.time import MS, div, instant, micros, to_us
from tagloom.operators.retrieval import since, wide_us
from tagloom.operators.summary import statistics, weighted
from tagloom.plans.blocks import BLOCK_MS, in_order, runs
from tagloom.plans.ranges import SPLIT_ROWS, overlapping
from tagloom.sources.history import good_value, in_range_us, scan_history


def slice_by(
    df: DataFrame,
    slice_tag: str,
    summary_tags: Sequence[str],
    start,
    end,
    block_ms: int = BLOCK_MS,
    slice_value: str = "value",
) -> DataFrame:
    """Summarise tags over each constant-value run of a slicing tag.

    ``slice_value`` is the column the slicing tag is read from: numbers, or text
    such as a phase or a batch name.
    A slice runs from one change of ``slice_tag`` in (start, end) to the next,
    half-open; the last, open run yields no row. Values in force when a slice
    begins count towards it.

    Slices tile the range, so each stretch of a summary tag lies in exactly one
    of them: slice starts and samples are ordered together per tag and block,
    and no interval join is needed.
    """
    summary_tags = list(summary_tags)
    good = good_value(slice_value).alias("sv")
    slicing = scan_history(df, [slice_tag], start, end, "()").select("tag", micros(F.col("ts")).alias("us"), good)
    not_a_number = F.lit(float("nan"))
    # Values are filled forward, so a missing one needs a mark of its own.
    is_text = dict(df.dtypes)[slice_value] == "string"
    if is_text:
        marked = F.coalesce(F.concat(F.lit("="), F.col("sv")), F.lit(""))
    else:
        marked = F.coalesce("sv", not_a_number)
    starts = (
        runs(slicing, ["sv"], block_ms=block_ms)
        .select(
            F.explode(F.array(*[F.lit(t) for t in summary_tags])).alias("tag"),
            "us",
            F.lit(None).cast("double").alias("v"),
            F.col("us").alias("slice_us"),
            # The open run only ends the slice before it.
            F.coalesce("end_us", "us").alias("slice_end"),
            F.col("end_us").isNull().alias("slice_open"),
            marked.alias("slice_v"),
        )
    )
    samples = in_range_us(scan_history(df, summary_tags), start, end).select(
        "tag",
        "us",
        F.coalesce("value", not_a_number).alias("v"),
        F.lit(None).cast("long").alias("slice_us"),
        F.lit(None).cast("long").alias("slice_end"),
        F.lit(None).cast("boolean").alias("slice_open"),
        F.lit(None).cast("string" if is_text else "double").alias("slice_v"),
    )
    stretches = in_order(
        starts.unionByName(samples),
        ["v", "slice_us", "slice_end", "slice_open", "slice_v"],
        # At one instant the slice begins before the sample.
        tie_break=[F.col("slice_us").isNull()],
        marks={"sampled": F.col("v").isNotNull()},
        block_ms=block_ms,
    ).filter("NOT slice_open AND next_us > us")

    value = F.when(~F.isnan("v"), F.col("v"))
    sums = stretches.groupBy("tag", "slice_us", "slice_end", "slice_v").agg(
        F.count_if("sampled").alias("samples"),
        *weighted(value, F.col("next_us") - F.col("us")),
    )
    length = F.col("slice_end") - F.col("slice_us")
    stats = statistics(length)
    if is_text:
        shown = F.when(F.col("slice_v") != "", F.substring("slice_v", 2, 2**31 - 1))
    else:
        shown = F.when(~F.isnan("slice_v"), F.col("slice_v")).cast("string")
    return sums.select(
        instant(F.col("slice_us")).alias("start_ts"),
        instant(F.col("slice_end")).alias("end_ts"),
        shown.alias("slice_value"),
        "tag",
        stats.pop("average").alias("average"),
        div(length, MS).alias("duration_ms"),
        *[c.alias(name) for name, c in stats.items()],
    )


def summarise_within(
    df: DataFrame,
    tags: Sequence[str],
    spans: DataFrame,
    start,
    end,
    block_ms: int = BLOCK_MS,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Summarise tags over given intervals, which may overlap each other: incidents, batches, shifts.

    ``spans`` has ``start_ts``, ``end_ts`` (half-open) and any columns that tell intervals apart; equal rows count once. Values
    in force when an interval begins count towards it. Values are known from ``start`` on; the last one of a tag holds until
    ``end``. The result has the columns of ``spans``, ``tag`` and the statistics; an interval in which a tag has no sample
    in force, or without an end, has no row for it. Besides the statistics, ``spans`` may have any column but ``tag``.
    """
    not_a_number = F.lit(float("nan"))
    samples = in_range_us(scan_history(df, list(tags)), start, end).select("tag", "us", F.coalesce("value", not_a_number).alias("v"))
    held = in_order(samples, ["v"], block_ms=block_ms).select(
        "tag", F.col("us").alias("_us"), "v", F.coalesce("next_us", F.lit(to_us(end)).cast("long")).alias("_until")
    )
    known = spans.distinct().select("*", micros(F.col("start_ts")).alias("_from"), micros(F.col("end_ts")).alias("_to"))
    pairs = overlapping(held, known, (), ("_us", "_until"), ("_from", "_to"), split_rows)
    parts = pairs.select(
        *spans.columns,
        "tag",
        "_from",
        "_to",
        (F.col("_us") >= F.col("_from")).alias("_inside"),
        F.greatest("_us", "_from").alias("us"),
        F.least("_until", "_to").alias("_end"),
        F.when(~F.isnan("v"), F.col("v")).alias("_v"),
    )
    sums = parts.groupBy(*spans.columns, "tag", "_from", "_to").agg(
        F.count_if("_inside").alias("samples"), *weighted(F.col("_v"), F.col("_end") - F.col("us"))
    )
    length = F.col("_to") - F.col("_from")
    stats = statistics(length)
    return sums.select(*spans.columns, "tag", *[c.alias(name) for name, c in stats.items()])


def threshold_extrema(
    df: DataFrame,
    tag: str | Sequence[str],
    lo: float,
    hi: float,
    start,
    end,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Intervals in which a tag is at or below ``lo`` or at or above ``hi``.

    An excursion under way at ``start`` begins there; one still open at ``end``
    is left out. Bad and NULL samples end an excursion. A jump from one zone to
    the other closes one excursion and opens the next at the same instant.
    """
    tags = [tag] if isinstance(tag, str) else list(tag)
    rows = in_range_us(scan_history(df, tags), start, end).select(
        "tag",
        "us",
        "value",
        F.when(F.col("value") <= lo, "Min").when(F.col("value") >= hi, "Max").alias("edge"),
    )
    low = F.struct(F.col("value").alias("v"), F.col("us").alias("us"))
    high = F.struct(F.col("value").alias("v"), (-F.col("us")).alias("us"))
    excursions = runs(
        rows,
        ["edge"],
        block_ms=block_ms,
        aggs={
            "lowest": (F.min(low), F.min("lowest")),
            "highest": (F.max(high), F.max("highest")),
            "value": (F.min_by("value", "us"), F.min_by("value", "us")),
        },
    ).filter("edge IS NOT NULL AND end_us IS NOT NULL")
    return excursions.select(
        instant(F.col("us")).alias("start_ts"),
        instant(F.col("end_us")).alias("end_ts"),
        "tag",
        "edge",
        F.col("lowest.v").alias("minimum"),
        instant(F.col("lowest.us")).alias("min_ts"),
        F.col("highest.v").alias("maximum"),
        instant(-F.col("highest.us")).alias("max_ts"),
        (div(F.col("end_us"), MS) - div(F.col("us"), MS)).alias("duration_ms"),
        "value",
    )


# A limit rule: tag, one of ``>`` ``>=`` ``<`` ``<=``, limit.
Rule = tuple[str, str, float]


#: So many rules are written into the plan; up to so many, some megabytes, are sent to every task as a table.
RULES_INLINE, RULES_SENT = 64, 100_000


def with_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Samples of the tags that have rules, once for each different rule.

    The tags are filtered in the scan. A few rules are attached to each sample
    from literals. More are a table, so that the plan does not grow with their
    number; up to RULES_SENT of them no sample is shuffled for the join.
    """
    known = list(dict.fromkeys((t, op, float(x)) for t, op, x in rules))
    listed = scan_history(df, list(dict.fromkeys(t for t, _, _ in known)))
    if len(known) > RULES_INLINE:
        table = df.sparkSession.createDataFrame(known, "tag string, op string, limit double")
        if len(known) <= RULES_SENT:
            table = F.broadcast(table)
        return listed.join(table, "tag").select(*df.columns, "op", "limit")
    by_tag: dict[str, list] = {}
    for tag, op, limit in known:
        by_tag.setdefault(tag, []).append(F.struct(F.lit(op).alias("op"), F.lit(limit).alias("limit")))
    choice = F.lit(None).cast("array<struct<op:string,limit:double>>")
    for tag, its in by_tag.items():
        choice = F.when(F.col("tag") == tag, F.array(*its)).otherwise(choice)
    return listed.withColumn("_rule", F.explode(choice)).select("*", "_rule.op", "_rule.limit").drop("_rule")


def capacity_rules(
    memory_tag: str,
    cpu_tag: str,
    total_cores: int,
    usable_cores: int,
    memory_mb: float = 1000.0,
) -> list[Rule]:
    """Rules at 95 % of a memory limit and of the usable share of all cores."""
    return [
        (memory_tag, ">", 0.95 * memory_mb),
        (cpu_tag, ">", 95.0 / total_cores * usable_cores),
    ]


def broken(value: Column, op: Column, limit: Column) -> Column:
    """Whether a value breaks its rule; NULL values break none."""
    return F.coalesce(
        F.when(op == ">", value > limit)
        .when(op == ">=", value >= limit)
        .when(op == "<", value < limit)
        .when(op == "<=", value <= limit),
        F.lit(False),
    )


def incidents(
    df: DataFrame, rules: Sequence[Rule], start, end, block_ms: int = BLOCK_MS
) -> DataFrame:
    """Times in [start, end] at which a tag begins to break a rule, until the
    first sample that keeps it (NULL while still broken at ``end``).

    Only the rules' tags are read; samples are shuffled once, by tag, rule and
    block."""
    tags = list(dict.fromkeys(t for t, _, _ in rules))
    rows = (
        with_rules(since(scan_history(df, tags), start, end), rules)
        .select(
            "tag",
            "op",
            "limit",
            micros(F.col("ts")).alias("us"),
            "value",
            broken(F.col("value"), F.col("op"), F.col("limit")).alias("on"),
        )
    )
    first_us = to_us(start) if start is not None else None
    turns = runs(rows, ["on"], keys=["tag", "op", "limit"], block_ms=block_ms).filter("on")
    if first_us is not None:
        turns = turns.filter(F.col("us") >= first_us)
    return (
        turns.select(
            instant(F.col("us")).alias("start_ts"),
            instant(F.col("end_us")).alias("end_ts"),
            "tag",
            "value",
            div(F.col("end_us") - F.col("us"), MS).alias("duration_ms"),
        )
        .distinct()
        .orderBy("start_ts", "tag")
    )


def any_all(
    df: DataFrame, tags: Sequence[str], start, end, block_ms: int = BLOCK_MS
) -> DataFrame:
    """How long, and over how many rows, any, all or none of some on/off tags
    were on in [start, end].

    A NULL in any tag makes an instant count for none of the three.
    ``not_final`` is 1 when the last row has no later one to end it.
    """
    tags = list(tags)
    rows = wide_us(df, tags, start, end, block_ms)
    values = [F.col(f"`{t}`") for t in tags]
    total = reduce(lambda a, b: a + b, values)
    ms = div(F.col("next_us") - F.col("us"), MS)
    tests = {"none": total == 0, "all": total - (len(tags) - 1) == 1, "any": total > 0}
    return rows.select("us", ms.alias("ms"), *[t.alias(n) for n, t in tests.items()]).agg(
        instant(F.min("us")).alias("start_ts"),
        instant(F.max(F.col("us") + F.col("ms") * MS)).alias("end_ts"),
        *[F.sum(F.when(F.col(n), F.col("ms")).otherwise(0)).alias(f"{n}_ms") for n in tests],
        *[
            F.sum(F.when(F.col(n), 1).otherwise(0)).cast("long").alias(f"{n}_count")
            for n in tests
        ],
        F.count("*").alias("change_count"),
        F.sum(F.when(F.col("ms").isNull(), 1).otherwise(0)).cast("long").alias("not_final"),
    )

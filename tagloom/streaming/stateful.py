"""Limit incidents and threshold excursions of a stream whose samples come out of order.

Two stateful steps. The first is Spark's own window aggregation: the samples of each tag (and rule) are gathered per time slot,
sorted once the watermark has passed the slot, and reduced there to the stretches of equal state that a slot consists of. The
second, a ``transformWithState`` processor keyed by tag and rule, joins the stretches of successive slots. Of each slot it needs
the first and the last stretch and where the second begins, and because a slot is handed on only when it is final, it needs no
buffer: its state is the stretch a key is in. The stretches between are final; they pass by the same step in groups of at most
``GROUP``, each under a key of its own that keeps no state, because Spark holds in Python what one key gives at a time. So a
busy tag costs its slots, which are spread over all tasks, a few values of each in one task, and one small row of state.

The results are those of the batch operators over the same samples, whatever the order in which they arrive within ``delay``.
Samples later than that are dropped and counted by Spark as ``numRowsDroppedByWatermark``. What the watermark has not
passed yet is not given.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tagloom.functions.time import MS, SECOND, div, instant, micros
from tagloom.operators.intervals import Rule, broken, with_rules
from tagloom.session import ensure
from tagloom.sources.history import good_value, scan_history

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STRETCH = "us bigint, {}value double, low double, low_us bigint, high double, high_us bigint"
OPEN = f"state string, {STRETCH.format('last_us bigint, ')}"
GIVEN = ["state", "us", "end_us", "value", "low", "low_us", "high", "high_us"]
FIELDS = ["state", "us", "last_us", "value", "low", "low_us", "high", "high_us"]
#: Stretches within a slot that pass through Python at a time.
GROUP = 256


def _slots(samples: DataFrame, keys: list[str], value: Column, state: Column, delay: str, slot_s: int) -> DataFrame:
    """The samples of each key and time slot, sorted, as the array ``rows``."""
    row = F.struct(micros(F.col("ts")).alias("us"), value.cast("double").alias("value"), state.alias("state"))
    return (
        samples.withColumn("seen", F.col("ts").cast("timestamp"))
        .withWatermark("seen", delay)
        .groupBy(F.window("seen", f"{slot_s} seconds").alias("slot"), *keys)
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
    )


def _pieces(slots: DataFrame, keys: Sequence[str], silence_us: int | None) -> DataFrame:
    """The stretches of equal state in each slot's sorted samples, as one array per field.

    Each sample is looked at a fixed number of times: turns are found by comparing neighbours, and a stretch is a slice.
    """
    gap = f"OR x.us - rows[i - 1].us > {silence_us}" if silence_us else ""
    turns = slots.withColumn(
        "turns",
        F.expr(
            f"""filter(transform(rows, (x, i) -> CASE WHEN i = 0 OR NOT (x.state <=> rows[i - 1].state) {gap}
                                                 THEN i END), k -> k IS NOT NULL)"""
        ),
    )
    cut = turns.withColumn(
        "cut", F.expr("transform(turns, (k, j) -> slice(rows, k + 1, coalesce(get(turns, j + 1), size(rows)) - k))")
    )
    piece = """transform(cut, p -> named_struct(
        'state', p[0].state, 'us', p[0].us, 'last_us', p[size(p) - 1].us, 'value', p[0].value,
        'lowest', array_min(transform(p, x -> named_struct('v', x.value, 'us', x.us))),
        'highest', array_max(transform(p, x -> named_struct('v', x.value, 'us', -x.us)))))"""
    silent = f"get(pieces, j + 1).us - get(pieces, j).last_us > {silence_us}" if silence_us else "false"
    # Of a slot the first stretch, the second as the end of the first, and the last. Those between are whole: they take
    # ``last_us`` to the processor as their end.
    edges = """CASE WHEN size(pieces) < 3 THEN pieces ELSE array(
        pieces[0], named_struct('state', CAST(NULL AS STRING), 'us', pieces[1].us, 'last_us', pieces[1].last_us,
                                'value', pieces[1].value, 'lowest', pieces[1].lowest, 'highest', pieces[1].highest),
        element_at(pieces, -1)) END"""
    whole = f"""transform(
        filter(sequence(1, greatest(size(pieces) - 2, 1)), j -> j < size(pieces) - 1 AND get(pieces, j).state IS NOT NULL),
        j -> named_struct('state', get(pieces, j).state, 'us', get(pieces, j).us,
                          'last_us', CASE WHEN NOT ({silent}) THEN get(pieces, j + 1).us END, 'value', get(pieces, j).value,
                          'lowest', get(pieces, j).lowest, 'highest', get(pieces, j).highest))"""
    groups = f"""concat(array(named_struct('_group', CAST(NULL AS BIGINT), 'some', edges)),
        transform(filter(sequence(0, size(whole) DIV {GROUP}), g -> g * {GROUP} < size(whole)),
                  g -> named_struct('_group', xxhash64(slot, g), 'some', slice(whole, g * {GROUP} + 1, {GROUP}))))"""
    # One array per field: nested rows would reach Python as dictionaries.
    fields = {"low": "lowest.v", "low_us": "lowest.us", "high": "highest.v", "high_us": "highest.us"}
    found = cut.withColumn("pieces", F.expr(piece)).withColumn("edges", F.expr(edges)).withColumn("whole", F.expr(whole))
    grouped = found.select(F.window_time("slot").alias("slot_ts"), *keys, F.explode(F.expr(groups)).alias("g"))
    return grouped.select("slot_ts", *keys, "g._group", *[F.col(f"g.some.{fields.get(f, f)}").alias(f) for f in FIELDS])


class _Stretches(StatefulProcessor):
    """Joins the pieces of successive slots and gives each stretch with a state once it has ended."""

    def __init__(self, keys: list[str], silence_us: int | None, slot_us: int) -> None:
        self.keys, self.silence_us, self.slot_us = keys, silence_us, slot_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _given(self, key: tuple, piece: tuple, end_us: int | None) -> Iterator[Row]:
        state, us, _, *rest = piece
        if state is not None:
            yield Row(*self.keys, *GIVEN)(*key[: len(self.keys)], state, us, end_us, *rest)

    def _silent(self, piece: tuple, until_us: int) -> bool:
        return self.silence_us is not None and until_us - piece[2] > self.silence_us

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[-1] is not None:  # a group of whole stretches
            for r in rows:
                for piece in zip(*(r[f] for f in FIELDS)):
                    yield from self._given(key, piece, piece[2])
            return
        known = self.open.get() if self.open.exists() else None
        now = tuple(known) if known is not None else None
        # Slots of one key do not overlap, and a later batch holds later slots only.
        for slot in sorted((tuple(r[f] for f in FIELDS) for r in rows), key=lambda arrays: arrays[1][0]):
            for piece in zip(*slot):
                if now is not None and self._silent(now, piece[1]):
                    yield from self._given(key, now, None)
                    now = None
                if now is not None and now[0] == piece[0]:
                    lowest, highest = min(now[4:6], piece[4:6], key=_order), max(now[6:], piece[6:], key=_order)
                    now = (*now[:2], piece[2], now[3], *lowest, *highest)
                    continue
                if now is not None:
                    yield from self._given(key, now, piece[1])
                now = piece
        if now is None:
            return
        self.open.update(now)
        if self.silence_us is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # A slot that the watermark has not passed by then begins after the silence.
            self.handle.registerTimer(-(-(now[2] + self.silence_us + self.slot_us) // MS))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists():
            yield from self._given(key, tuple(self.open.get()), None)
            self.open.clear()

    def close(self) -> None:
        pass


def _order(pair: tuple) -> tuple:
    """Sorts as Spark does: NULL first, NaN above all numbers."""
    v, us = pair
    return (v is not None, v is not None and v != v, 0.0 if v is None or v != v else v, us)


def stretches(
    samples: DataFrame, keys: Sequence[str], value: Column, state: Column, delay: str, slot_s: int, silence_s: int | None
) -> DataFrame:
    """Ended stretches of equal, non-NULL ``state`` per key: keys, state, us, end_us, value, low, low_us, high, high_us.

    ``silence_s``: a key without a sample for longer than that ends unfinished. Its stretch is given without end and its state
    forgotten, by a timer or by the next sample, whichever the stream shows first; the rows are the same. Without it the
    state of a tag that is no longer written stays.
    """
    spark = samples.sparkSession
    ensure(spark)
    # The processor's state and timers need this store; a query takes the setting when it starts.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    keys = list(keys)
    silence_us = None if silence_s is None else silence_s * SECOND
    pieces = _pieces(_slots(samples, keys, value, state, delay, slot_s), keys, silence_us)
    types = dict(pieces.dtypes)
    shape = ", ".join(f"{k} {types[k]}" for k in keys)
    return pieces.groupBy(*keys, "_group").transformWithState(
        _Stretches(keys, silence_us, slot_s * SECOND),
        f"{shape}, state string, {STRETCH.format('end_us bigint, ')}",
        "append",
        "none" if silence_us is None else "eventTime",
    )


def watch_incidents(
    samples: DataFrame,
    rules: Sequence[Rule],
    delay: str = "5 minutes",
    slot_s: int = 60,
    silence_s: int | None = None,
) -> DataFrame:
    """The incidents of ``intervals.incidents`` with the rule each breaks, as a stream to be written in append mode.

    An incident is given once the sample that ends it lies in a slot of ``slot_s`` that is ``delay`` behind the newest
    sample; one that ends in a silence has no end.
    """
    ruled = with_rules(samples, rules)
    on = F.when(broken(F.col("value"), F.col("op"), F.col("limit")), F.lit("on"))
    found = stretches(ruled, ["tag", "op", "limit"], F.col("value"), on, delay, slot_s, silence_s)
    return found.select(
        instant(F.col("us")).alias("start_ts"),
        instant(F.col("end_us")).alias("end_ts"),
        "tag",
        "op",
        "limit",
        "value",
        div(F.col("end_us") - F.col("us"), MS).alias("duration_ms"),
    )


def watch_excursions(
    samples: DataFrame,
    tags: Sequence[str],
    lo: float,
    hi: float,
    delay: str = "5 minutes",
    slot_s: int = 60,
    silence_s: int | None = None,
) -> DataFrame:
    """The excursions of ``intervals.threshold_extrema``, from a tag's first sample on, as a stream in append mode.

    Bad and NULL samples end an excursion. One that ends in a silence has no end.
    """
    value = good_value()
    edge = F.when(value <= lo, "Min").when(value >= hi, "Max")
    found = stretches(scan_history(samples, tags), ["tag"], value, edge, delay, slot_s, silence_s)
    return found.select(
        instant(F.col("us")).alias("start_ts"),
        instant(F.col("end_us")).alias("end_ts"),
        "tag",
        F.col("state").alias("edge"),
        F.col("low").alias("minimum"),
        instant(F.col("low_us")).alias("min_ts"),
        F.col("high").alias("maximum"),
        instant(-F.col("high_us")).alias("max_ts"),
        (div(F.col("end_us"), MS) - div(F.col("us"), MS)).alias("duration_ms"),
        "value",
    )

"""Time arithmetic on columns.

Operators keep instants as ``timestamp_ntz`` at their edges and as epoch
microseconds (``us``, long) inside, so that windows sort on longs and
durations are plain integer arithmetic. The session time zone must be UTC
(see ``tagloom.session.configure``); then the conversions lose nothing.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
MS = 1_000
SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

_FIXED_UNITS = {
    "microsecond": 1,
    "millisecond": MS,
    "second": SECOND,
    "minute": MINUTE,
    "hour": HOUR,
    "day": DAY,
    "week": 7 * DAY,
}
_MONTHS_PER_UNIT = {"month": 1, "quarter": 3, "year": 12}


def as_datetime(value: str | date | datetime) -> datetime:
    """A naive datetime from a datetime, a date or ISO text."""
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(value, datetime):
        return value
    return datetime(value.year, value.month, value.day)


def to_us(value: str | date | datetime) -> int:
    """Epoch microseconds of a naive instant, on the driver."""
    return (as_datetime(value) - EPOCH) // timedelta(microseconds=1)


def midnight(value: str | date | datetime, days: int = 0) -> datetime:
    """Start of the day of ``value``, moved by ``days``."""
    d = as_datetime(value)
    return datetime(d.year, d.month, d.day) + timedelta(days=days)


def ts_lit(value: str | date | datetime) -> Column:
    """A ``timestamp_ntz`` literal: comparing it leaves the column uncast, so
    the filter reaches the Parquet scan."""
    return F.expr(f"TIMESTAMP_NTZ'{as_datetime(value).isoformat(sep=' ')}'")


def between_ts(col: Column, start, end, bounds: str = "[)") -> Column:
    """Range test with explicit open or closed ends, e.g. ``"()"`` or ``"(]"``.
    ``None`` leaves an end unbounded."""
    if len(bounds) != 2 or bounds[0] not in "([" or bounds[1] not in ")]":
        raise ValueError(f"bounds must be one of (), (], [), []; got {bounds!r}")
    test = F.lit(True)
    if start is not None:
        test = test & ((col >= ts_lit(start)) if bounds[0] == "[" else (col > ts_lit(start)))
    if end is not None:
        test = test & ((col <= ts_lit(end)) if bounds[1] == "]" else (col < ts_lit(end)))
    return test


def micros(col: Column) -> Column:
    """Epoch microseconds of a timestamp column."""
    return F.unix_micros(col.cast("timestamp"))


def instant(us: Column) -> Column:
    """``timestamp_ntz`` of epoch microseconds."""
    return F.timestamp_micros(us).cast("timestamp_ntz")


def div(a: Column, b: Column | int) -> Column:
    """Integer division, truncating."""
    b = b if isinstance(b, Column) else F.lit(b).cast("long")
    return F.call_function("div", a, b)


def floor_div(a: Column, n: int) -> Column:
    """Integer division, rounding down (also before 1970)."""
    step = F.lit(n).cast("long")
    return div(a - F.pmod(a, step), step)


def boundary_diff(unit: str, a: Column, b: Column) -> Column:
    """How many ``unit`` boundaries lie between two timestamps.

    00:59:59 to 01:00:00 is one hour, although a second has passed.
    """
    unit = unit.lower()
    if unit in _FIXED_UNITS:
        n = _FIXED_UNITS[unit]
        return floor_div(micros(b), n) - floor_div(micros(a), n)
    if unit in _MONTHS_PER_UNIT:
        n = _MONTHS_PER_UNIT[unit]

        def index(c: Column) -> Column:
            return (F.year(c).cast("long") * 12 + F.month(c) - 1)

        return floor_div(index(b), n) - floor_div(index(a), n)
    raise ValueError(f"unknown unit {unit!r}")


def trunc(unit: str, ts: Column) -> Column:
    """Start of the ``unit`` that holds ``ts``."""
    return F.date_trunc(unit, ts.cast("timestamp")).cast("timestamp_ntz")


def floor_time(ts: Column, seconds: int) -> Column:
    """``ts`` rounded down to a multiple of ``seconds``, counted from the fixed
    reference instant 2015-01-01."""
    reference = to_us("2015-01-01")
    step = F.lit(seconds * SECOND).cast("long")
    us = micros(ts)
    return instant(us - F.pmod(us - F.lit(reference), step))


def shift(ts: Column, **amount: Column | int) -> Column:
    """``ts`` moved by days, hours, minutes, seconds or milliseconds."""
    us = micros(ts)
    for unit, n in amount.items():
        n = n if isinstance(n, Column) else F.lit(n)
        us = us + n.cast("long") * F.lit(_FIXED_UNITS[unit.rstrip("s")]).cast("long")
    return instant(us)

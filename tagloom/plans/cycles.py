"""Evenly spaced cycles over a time range."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.time import MS, div, to_us


@dataclass(frozen=True)
class Cycles:
    """Cycles ``0 .. count-1`` tiling [start, end); the last one ends at ``end``."""

    start_us: int
    end_us: int
    width_us: int
    count: int

    @classmethod
    def of(cls, start, end, resolution_ms: int | None = None, cycles: int | None = None) -> Cycles:
        """By cycle length or by number of cycles (one cycle if neither is given)."""
        lo, hi = to_us(start), to_us(end)
        if hi <= lo:
            raise ValueError("end must be after start")
        if resolution_ms is not None and cycles is not None:
            raise ValueError("give resolution_ms or cycles, not both")
        if resolution_ms is not None:
            width = resolution_ms * MS
            count = -(-(hi - lo) // width) if width > 0 else 0
        else:
            count = 1 if cycles is None else cycles
            width = (hi - lo) // count if count > 0 else 0
        if width < 1:
            raise ValueError("cycles must be at least a microsecond long")
        return cls(lo, hi, width, count)

    def index(self, us: Column) -> Column:
        """Cycle of an instant in [start, end)."""
        k = div(us - F.lit(self.start_us).cast("long"), self.width_us)
        return F.least(k, F.lit(self.count - 1).cast("long"))

    def begin(self, k: Column) -> Column:
        return F.lit(self.start_us).cast("long") + k * F.lit(self.width_us).cast("long")

    def finish(self, k: Column) -> Column:
        """End of cycle ``k``: the start of the next one, or ``end``."""
        end = F.lit(self.end_us).cast("long")
        return F.when(k >= self.count - 1, end).otherwise(F.least(self.begin(k + 1), end))

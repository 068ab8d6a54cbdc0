"""The operators applied to the given tables, each paired with plain SQL."""

from tagloom.workload import reports, series, streams  # noqa: F401
from tagloom.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

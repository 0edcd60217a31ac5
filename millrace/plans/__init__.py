"""Registered queries: each runs one operator over whole tables, with the SQL that must give the same rows."""

from millrace.plans import mining, models, series, sources, tables  # noqa: F401  (importing registers the queries)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

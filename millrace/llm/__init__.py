"""Operators that prepare text for training: filters, copies, sharding, search, mixing, archives, tokens."""

from millrace.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Queries on the given tables with their oracle SQL."""

from clubflow.catalog import loads, marts, relational, scalars, windows  # noqa: F401
from clubflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

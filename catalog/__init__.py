"""Registered queries: every operator on the driver tables, with its oracle SQL."""

from catalog import aggregations, analysis, filters, lifecycle, scored, searching, values, writing  # noqa: F401
from catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

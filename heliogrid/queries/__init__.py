"""Queries over the given tables, each with its reference SQL where SQL can express it."""

from heliogrid.queries import climate, cleaning, files, mart, models, places, readings, scoring, sinks  # noqa: F401
from heliogrid.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Registered queries and the SQL that checks each of them."""

from . import cleaning, features, modelling, fits, evaluation, patterns, runs, series, sources, stats  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

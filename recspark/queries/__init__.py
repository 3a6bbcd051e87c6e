"""Registered queries with the SQL that checks them."""

from . import (aggregates, analysis, expressions, graphs, jobs, measures, models,  # noqa: F401
               recommend, relational, samples, storage, streams)
from .registry import QUERIES, SQL_CHECKS

__all__ = ["QUERIES", "SQL_CHECKS"]

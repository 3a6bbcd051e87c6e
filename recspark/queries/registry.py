from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL_CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, path) -> DataFrame`` under ``name`` with its SQL check, if any."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL_CHECKS[name] = sql
        return fn
    return add

"""Registered queries: each operator on the given tables, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its checking SQL, if SQL can express it on whole tables."""

    def register(build: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register

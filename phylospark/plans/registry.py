"""Registered queries by name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def add(f: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add

"""Queries by name, with the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame; sql, if any, follows the derived tables' definitions."""

    def add(f):
        from .derived import SQL

        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are named {key}")
        QUERIES[key] = f
        if sql:
            body = sql.strip()
            ORACLE_SQL[key] = f"{SQL}, {body[5:]}" if body.upper().startswith("WITH ") else f"{SQL}{body}"
        return f

    return add

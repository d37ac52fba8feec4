"""Queries of this subpackage: Spark callables and, where SQL can express the
result, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def load_all() -> None:
    from tallyhawk.llm import queries  # noqa: F401

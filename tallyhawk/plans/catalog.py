"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in SQL, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ts_text(c) -> Column:
    """Timestamps leave queries as text with microseconds, so both engines
    render them identically."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def ts_sql(expr: str) -> str:
    return f"strftime(cast({expr} as timestamp), '%Y-%m-%d %H:%M:%S.%f')"


def load_all() -> None:
    from tallyhawk.plans import (queries_features, queries_labels, queries_metrics,  # noqa: F401
                                 queries_prep, queries_sources, queries_gate, queries_ml, queries_streams)

"""Registered queries: each binds operators to the test tables and, where SQL can
express the result, carries an equivalent DuckDB query used as the oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

MODULES = ("behaviour", "catalog", "ratings", "hybrid", "text", "evaluation", "coldstart",
           "conversation", "summary", "models")


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)

"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def wrap(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise KeyError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return wrap


def sql_of(name: str) -> str:
    """SQL of a query registered before, for queries built from others."""
    return _SQL[name]


def _load_all() -> None:
    # Importing the modules registers their queries.
    from . import (queries_core, queries_decisions, queries_drift, queries_eval, queries_features,  # noqa: F401
                   queries_ml, queries_quality, queries_relevance, queries_select, queries_stream,
                   queries_upload)


def queries() -> dict[str, Builder]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)

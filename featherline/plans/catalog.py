"""Registry of named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under a name, with the SQL that gives the same rows."""

    def add(f):
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def _define() -> None:
    from featherline.plans import definitions, models, series, surface, vectors  # noqa: F401  they register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _define()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _define()
    return dict(_SQL)

"""All queries of the library by name, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame under a name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL


from tidemark.plans import checks, footage, frames, media, sources  # noqa: E402, F401  they register their queries

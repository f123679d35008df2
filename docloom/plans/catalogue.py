"""Registered queries of the document operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Adds a query under a name, with its SQL where SQL can express it."""

    def add(f):
        _QUERIES[name] = f
        if sql:
            _ORACLES[name] = sql
        return f

    return add


def _load() -> None:
    from docloom.plans import cases, queries  # noqa: F401  fill the registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _QUERIES["chunk_sections"](spark, sf_dir)

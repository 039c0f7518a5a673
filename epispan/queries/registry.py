"""Query registry."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .standins import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = [
    "sources", "scalars", "filters_joins", "aggregates", "series", "statistics", "quality", "publication",
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the statement that checks it."""
    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query registered twice: {name}")
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = with_ctes(sql)
        return function

    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__package__}.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)

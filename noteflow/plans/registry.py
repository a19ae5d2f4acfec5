"""Query registry: one Spark query and (where SQL can express it) one oracle SQL per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise KeyError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn
    return deco


def _load():
    from . import q_prep, q_text, q_split, q_eval, q_models, q_fits, q_sources  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)

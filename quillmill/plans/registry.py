"""All queries over the operators of this package, with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill import shipped

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_MODULES = ("q_corpus", "q_records", "q_layout", "q_export", "q_annotations")


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``f(spark, sf_dir)`` under ``name``, with its SQL where SQL can express it."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        _QUERIES[name] = shipped(f)
        if sql:
            _SQL[name] = sql
        return f

    return add


def _load() -> None:
    import importlib

    for m in _MODULES:
        importlib.import_module(f"quillmill.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)

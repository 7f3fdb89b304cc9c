"""All queries of the library by key, and the SQL that a reference database answers them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query (spark, sf_dir) under its key, with its SQL where SQL can express it."""

    def add(f: Query) -> Query:
        _QUERIES[key] = f
        if sql:
            _ORACLES[key] = sql
        return f

    return add


def _load() -> None:
    import importlib
    import pkgutil

    import folio.plans as plans

    for m in pkgutil.iter_modules(plans.__path__):
        if m.name.startswith("q_"):
            importlib.import_module(f"folio.plans.{m.name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)

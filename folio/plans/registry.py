"""Where queries and the SQL that must give the same rows are registered."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}

#: Modules that register queries when imported.
MODULES: list[str] = [f"folio.plans.{m}" for m in ("metrics", "quality", "relations", "texts", "entities", "storage", "streams", "functions")]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; sql is what DuckDB runs over the same tables."""

    def put(function: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = function
        if sql is not None:
            _oracles[name] = sql
        return function

    return put


def _load() -> None:
    for module in MODULES:
        importlib.import_module(module)


def registered() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Name -> (Spark query, oracle SQL) registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .bindings import Tables, with_bindings


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the binding names (ser, grid, mach, ...) as tables."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(fn, with_bindings(sql) if sql else None)
        return fn

    return register


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, sf_dir: q.run(Tables(spark, sf_dir))

    return {name: bind(q) for name, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}

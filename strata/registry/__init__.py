"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

MODULES = ("rollups", "windows", "cleaning", "documents", "storage", "quality", "monitoring", "streams")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        from strata.registry.views import present

        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return fn

    return add


def load_all() -> None:
    for module in MODULES:
        import_module(f"strata.registry.{module}")

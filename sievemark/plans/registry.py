"""Registry of queries: operator id → (builder, SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..bindings import Tables

Builder = Callable[[Tables], DataFrame]
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under an operator id, with the SQL that must give the same rows."""
    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def runnable(build: Builder) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Tables(spark, folder))

"""Query name -> function and SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnwork.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``sql`` gives the same rows from the same tables."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return fn

    return register

"""Collects queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.standins import Standins, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(standins) -> DataFrame``; without SQL the check counts rows only."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Standins(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_ctes(sql)
        return fn

    return register

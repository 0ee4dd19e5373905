"""Where the query modules register: a Spark callable and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function
    return register

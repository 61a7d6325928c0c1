"""The one table of queries: each module of plans puts its own in when it is imported, and all are imported here."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of the same rows, where SQL can express a query.
SQL: dict[str, str] = {}
MODULES = ("queries", "runs", "corpus", "streams")


def query(sql: str | None = None):
    """Put a function (spark, folder of tables) in under its own name, once."""

    def add(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def load() -> None:
    for name in MODULES:
        import_module(f"barque.plans.{name}")

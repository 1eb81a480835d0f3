"""Registered queries over the given tables, each with its reference SQL where one exists."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GROUPS = ("scans", "columns", "sampling", "fitting", "text", "evaluation", "decisions", "models", "streams")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with SQL giving the same rows where there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for group in GROUPS:
        importlib.import_module(f"flowsift.catalog.{group}")
    return QUERIES, ORACLES

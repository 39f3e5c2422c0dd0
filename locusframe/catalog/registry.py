"""Query registry and the SQL views the oracles share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .adapters import Tables

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    """Declare a named SQL view; it may use the views declared before it."""
    VIEWS[name] = sql.strip()


def with_views(body: str) -> str:
    """Prepend the views a statement needs, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    ordered = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    recursive = "RECURSIVE " if "/*recursive*/" in body else ""
    own = body.replace("/*recursive*/", "").strip()
    if not ordered:
        return own
    if own.lower().startswith("with "):
        return f"WITH {recursive}" + ",\n".join(ordered) + ",\n" + own[5:]
    return f"WITH {recursive}" + ",\n".join(ordered) + "\n" + own


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its optional oracle."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLES.items()}

"""Registered queries: a callable over (spark, folder) and, where SQL can say it, its SQL twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parlance.plans.oracle_views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(body: str) -> str:
    """Prefix the derived views that a statement uses, in dependency order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in needed)
    return f"with {ctes}\n{body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register

"""Registered queries: a DataFrame function each, with the SQL that must give the same result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.workload.views import SQL_VIEWS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``function(tables)`` under its name; ``sql`` may use the views by name."""

    def register(function):
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return function

    return register


def with_views(sql: str) -> str:
    """Prefix a statement with the views it needs, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for view, body in SQL_VIEWS.items():
            if re.search(rf"\b(FROM|JOIN)\s+{view}\b", text) and view not in needed:
                visit(body)
                needed.append(view)

    visit(sql)
    views = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in needed)
    body = sql.strip()
    if not needed:
        return body
    if body[:4].upper() == "WITH":
        return f"WITH {views},\n{body[4:]}"
    return f"WITH {views}\n{body}"


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Floating results rounded for comparison."""
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})

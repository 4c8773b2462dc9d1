"""Registered queries and their SQL, with the adapter views a SQL text uses put in front of it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortweave.catalog.views import SQL_VIEWS
from cohortweave.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in SQL_VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(SQL_VIEWS[name])

    visit(sql)
    ctes = [f"{name} AS ({text.strip()})" for name, text in SQL_VIEWS.items() if name in needed]
    body = sql.strip()
    own = re.match(r"WITH\s+", body, re.IGNORECASE)
    if own:
        ctes.append(body[own.end() :])
        return "WITH " + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register

"""Query registry: a name, a Spark function and (where SQL can express it) an oracle."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidecast.workload.oracle_views import CTES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the views of ``oracle_views`` by name."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn

    return wrap


def _uses(text: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text))
    return [name for name in CTES if name in words]


def expand(sql: str) -> str:
    """Prefix the SQL with the views it needs, dependencies first."""
    needed: set[str] = set()
    todo = _uses(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in _uses(CTES[name]) if n != name]
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{name} AS ({body.strip()})" for name, body in CTES.items() if name in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"

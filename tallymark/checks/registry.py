"""Registry of queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}


def fragment(name: str, sql: str) -> None:
    """Named SQL block that twins may select from."""
    FRAGMENTS[name] = sql


def _needed(sql: str, found: list[str]) -> list[str]:
    for name, body in FRAGMENTS.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            found.append(name)
    return found


def with_fragments(sql: str) -> str:
    """SQL with the blocks it uses in front."""
    names = _needed(sql, [])
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({FRAGMENTS[n]})" for n in names) + "\n" + sql


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL twin."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_fragments(sql)
        return run

    return register

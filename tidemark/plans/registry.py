"""All registered queries and their SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        FOUND[f.__name__] = (f, sql)
        return f

    return add


def queries() -> dict[str, Query]:
    from . import market, stored  # noqa: F401

    return {n: f for n, (f, _) in FOUND.items()}


def oracle_sql() -> dict[str, str]:
    from . import market, stored  # noqa: F401

    return {n: s for n, (_, s) in FOUND.items() if s}

"""Registry of named queries: a Spark builder plus (optionally) the ANSI SQL
that DuckDB runs on the same parquet tables as the oracle.

A query without SQL is checked rows-only by the driver (and against a brute
force answer in ``tests/``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
SECTION: dict[str, str] = {}


def query(name: str, sql: str | None = None, section: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SECTION[name] = section
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their decorators run."""
    from . import (marts, q_aggs, q_functions, q_joins, q_relational,  # noqa: F401
                   q_series, q_sources, q_streaming)

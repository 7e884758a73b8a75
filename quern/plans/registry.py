"""Registry of the queries that make up the operator inventory.

Each registered query is a function ``(spark, sf_dir) -> DataFrame`` named by
its operator id (``str_06_tumbling_window``); ``sql`` is an equivalent ANSI
query over the same tables that an independent engine can run as an oracle.
Queries without SQL (stateful streaming, automata) carry ``sql=None``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    bench: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, *, bench: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, bench)
        return fn
    return deco


def add(name: str, fn: QueryFn, sql: str | None = None, *,
        bench: bool = False) -> None:
    register(name, sql, bench=bench)(fn)

"""Query registry: name -> (Spark plan builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: QueryFn
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ids: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name!r}")
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn

    return deco

"""Registry of named queries: a Spark callable ``(spark, sf_dir) ->
DataFrame`` and, where SQL can express it, the equivalent DuckDB SQL over
the raw test tables (used as the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    from . import (q_eval, q_geo, q_listings, q_ml, q_requests, q_segments, q_sources)  # noqa: F401

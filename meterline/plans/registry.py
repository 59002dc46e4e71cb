"""Registry of named queries (Spark callable + optional DuckDB oracle SQL)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.oracle_sql import with_base

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, raw_oracle: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is the body of a DuckDB query over the base CTEs of
    ``meterline.oracle_sql`` (or a complete query with ``raw_oracle``)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle if raw_oracle else with_base(oracle)
        return fn
    return deco

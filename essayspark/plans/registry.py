"""Registry of the driver queries: a Spark builder and, where the operator
is expressible in SQL, the DuckDB oracle text for the same result."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from essayspark.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def r6(c: Column | str, name: str | None = None) -> Column:
    """Round a double to 6 decimals so both engines hash the same value
    (adding 0.0 turns a negative zero into zero)."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), 6) + F.lit(0.0)
    return out.alias(name) if name else out


def r6_sql(e: str) -> str:
    return f"(round(CAST({e} AS DOUBLE), 6) + 0.0)"

"""Registry of driver queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional DuckDB twin."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def round6(df: DataFrame, cols) -> DataFrame:
    """Round the given double columns to 6 decimals (the SQL twins do the same)."""
    from pyspark.sql import functions as F
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])

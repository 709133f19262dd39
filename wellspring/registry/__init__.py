"""Registered queries with, where SQL can express them, a check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring import fixtures

Tables = Callable[[str], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def presented(df: DataFrame) -> DataFrame:
    """Engine-neutral output types: decimals as double, dates as ISO text."""

    def shown(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            return column.cast("double").alias(name)
        if kind == "date":
            return column.cast("string").alias(name)
        return column

    return df.select(*[shown(n, k) for n, k in df.dtypes])


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(fn(lambda table: fixtures.table(spark, sf_dir, table)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = fixtures.with_views(oracle)
        return fn

    return register


def load() -> None:
    """Import every module that registers queries."""
    from wellspring.registry import (  # noqa: F401
        cookbook,
        functions,
        incremental,
        operators,
        quality,
        silver,
        sources,
        stored,
        views,
    )

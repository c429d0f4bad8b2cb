"""Registry of checkable queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def r6(c: Column | str) -> Column:
    """Six places, and plain zero for negative zero, as the oracle SQL does."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def rounded(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """All double columns to six places."""
    return df.select(
        *[r6(c).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes]
    )


def sql6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {alias}"

"""Registered queries, each with the SQL that states its expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` is standard SQL over the same tables."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which both engines hand out alike."""
    return df.select(
        *[
            F.col(name).cast("double") if kind.startswith("decimal") else F.col(name)
            for name, kind in df.dtypes
        ]
    )

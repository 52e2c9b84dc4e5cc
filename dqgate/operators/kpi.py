"""KPI values: an aggregate of a table, or the first value a query returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqgate.functions.columns import quoted
from dqgate.operators.metrics import as_result, kpi_value
from dqgate.sources.jdbc import Warehouse, query_warehouse


def kpi_agg(df: DataFrame, function: str, column: str) -> DataFrame:
    """One row with the aggregate as a decimal in `value` and as text in `value_text`."""
    found = kpi_value(df, function, column)
    return df.agg(as_result(found).alias("value"), found.cast("string").alias("value_text"))


def _first_value(result: DataFrame) -> DataFrame:
    first = quoted(result.columns[0])
    return result.select(as_result(first).alias("value"), first.cast("string").alias("value_text")).limit(1)


def kpi_sql(spark: SparkSession, query: str) -> DataFrame:
    """First column of the first row of a configured query over catalog tables."""
    return _first_value(spark.sql(query))


def kpi_warehouse(spark: SparkSession, warehouse: Warehouse, query: str) -> DataFrame:
    """The same for a query that the warehouse runs itself."""
    return _first_value(query_warehouse(spark, warehouse, query))


def query_text(function: str, column: str, fmt: str, path: str) -> str:
    """How a KPI on a path is shown in results."""
    return f"SELECT {function}({column}) AS {function} FROM {fmt.upper()}.`{path}`"

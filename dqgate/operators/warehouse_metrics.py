"""Metrics of a warehouse table, computed by the warehouse: one query, one row comes back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dqgate.functions.columns import resolve
from dqgate.operators.metrics import METRICS_PER_PASS, Metric, metric_row_sql
from dqgate.sources.jdbc import Warehouse, query_warehouse

Quote = Callable[[str], str]

_COUNT = "DECIMAL(19,0)"
# Field of a metric row that each kind fills.
_FIELD = {"rows": None, "nulls": "unexpected_rows", "in_list": "unexpected_rows", "latest": "as_of_max"}


def dialect_quote(spark: SparkSession, warehouse: Warehouse) -> Quote:
    """How this warehouse writes the name of a column."""
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(warehouse.url)
    return dialect.quoteIdentifier


def _literal(text: str, kind: T.DataType) -> str | None:
    """A listed text as a literal of the column's type; None if it is no value of it."""
    try:
        if isinstance(kind, T.StringType):
            return "'{}'".format(text.replace("'", "''"))
        if isinstance(kind, T.IntegralType):
            number = Decimal(text.strip())
            return str(int(number)) if number == int(number) else None
        if isinstance(kind, T.DecimalType):
            number = Decimal(text.strip())
            return format(number, "f") if number.is_finite() else None
        if isinstance(kind, T.DateType):
            return f"DATE '{dt.date.fromisoformat(text.strip()).isoformat()}'"
    except (InvalidOperation, ValueError, OverflowError):
        return None
    raise TypeError(kind)


def pushable(schema: T.StructType, metric: Metric) -> bool:
    """Whether the warehouse gives the same answer as Spark would.

    Row and null counts always; listed values of texts, whole numbers, decimals and dates; the
    latest of a date or time column. Backslashes mean different things in different warehouses, so
    lists that hold one are compared in Spark.
    """
    if metric.kind in ("rows", "nulls"):
        return True
    if metric.column is None or metric.kind not in _FIELD:
        return False
    kind = next((f.dataType for f in schema.fields if f.name.lower() == metric.column.lower()), None)
    if metric.kind == "latest":
        return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    exact = (T.StringType, T.IntegralType, T.DecimalType, T.DateType)
    return isinstance(kind, exact) and not any("\\" in v for v in metric.values)


def _aggregate(table: DataFrame, metric: Metric, quote: Quote) -> str | None:
    """The metric as an aggregate in the warehouse's SQL; None for a row count, which is always there."""
    counted = f"SUM(CAST(CASE WHEN {{}} THEN 1 ELSE 0 END AS {_COUNT}))"
    if metric.kind == "rows":
        return None
    name = resolve(table, metric.column)
    if metric.kind == "nulls":
        return counted.format(f"{quote(name)} IS NULL")
    if metric.kind == "latest":
        return f"MAX({quote(name)})"
    values = [v for v in (_literal(v, table.schema[name].dataType) for v in metric.values) if v is not None]
    return counted.format(f"{quote(name)} IN ({', '.join(values)})" if values else "1 = 0")


def metrics_query(table: DataFrame, location: str, metrics: Sequence[Metric], quote: Quote) -> str:
    """One query for all metrics: `TOTAL_ROWS` and `M0`, `M1`, ... in a single row."""
    columns = [f"SUM(CAST(1 AS {_COUNT})) AS TOTAL_ROWS"]
    for i, metric in enumerate(metrics):
        sql = _aggregate(table, metric, quote)
        if sql is not None:
            columns.append(f"{sql} AS M{i}")
    return f"SELECT {', '.join(columns)} FROM {location}"


def warehouse_passes(
    spark: SparkSession, warehouse: Warehouse, table: DataFrame, location: str, metrics: Sequence[Metric], quote: Quote | None = None
) -> list[tuple[list[Metric], DataFrame]]:
    """Metric rows of one warehouse table, by the query that gives them.

    `table` is only asked for its schema. However large it is, a query transfers one row.
    """
    quote = quote or dialect_quote(spark, warehouse)
    passes = []
    for start in range(0, len(metrics), METRICS_PER_PASS):
        taken = list(metrics[start : start + METRICS_PER_PASS])
        measured = query_warehouse(spark, warehouse, metrics_query(table, location, taken, quote))
        rows = []
        for i, metric in enumerate(taken):
            known = {"total_rows": "coalesce(TOTAL_ROWS, 0)"}
            if field := _FIELD[metric.kind]:
                known[field] = f"M{i}" if metric.kind == "latest" else f"coalesce(M{i}, 0)"
            rows.append(metric_row_sql(metric.check_id, metric.side, known))
        passes.append((taken, measured.selectExpr(f"inline(array({', '.join(rows)}))")))
    return passes

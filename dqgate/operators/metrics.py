"""Metrics of one table, computed together in as few scans as possible."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate.functions.columns import quoted, resolve
from dqgate.names import KPI_AGGREGATES
from dqgate.schemas import METRIC_SCHEMA, RESULT_TYPE

# Aggregates per pass over a table. Beyond this the generated code of one
# aggregate grows too large to be compiled as a whole; more metrics take a
# further pass over the columns they need.
METRICS_PER_PASS = 60


@dataclass(frozen=True)
class Metric:
    """What to measure for one check: `kind` is rows, nulls, in_list, latest or aggregate."""

    check_id: int
    kind: str
    column: str | None = None
    values: tuple[str, ...] = ()
    function: str | None = None
    side: str = "main"


def null_count(df: DataFrame, column: str) -> Column:
    return F.count_if(quoted(resolve(df, column)).isNull())


def in_list_count(df: DataFrame, column: str, values: Sequence[str]) -> Column:
    """Rows whose value is in the list. Listed texts that are no value of the
    column's type cannot occur in it and are left out of the comparison."""
    name = resolve(df, column)
    data_type = df.schema[name].dataType
    literals = [F.lit(v).try_cast(data_type) for v in values]
    if not literals:
        return F.count_if(F.lit(False))
    return F.count_if(F.coalesce(quoted(name).isin(*literals), F.lit(False)))


def kpi_value(df: DataFrame, function: str, column: str) -> Column:
    """A configured aggregate of a column, or of an expression over the table's columns.

    Text that is no number counts as missing in a numeric aggregate of a column, and sums of
    whole numbers are taken as decimals, so that no value can stop the job. Any other
    aggregate function, `DISTINCT x`, and expressions are taken as Spark reads them.
    Raises when that gives no aggregate.
    """
    name = function.strip().lower()
    if not re.fullmatch("[a-z_][a-z0-9_]*", name):
        raise ValueError(f"{function!r} is no name of an aggregate")
    known = [c for c in df.columns if c.lower() == column.strip().lower()]
    if column.strip() != "*" and (name not in KPI_AGGREGATES or not known):
        return _expression(df, name, column)
    if column.strip() == "*":
        return getattr(F, name)(F.lit(1)) if name in KPI_AGGREGATES else _expression(df, name, "1")
    column = resolve(df, column)
    data_type, target = df.schema[column].dataType, quoted(column)
    if name in ("sum", "avg", "stddev", "variance"):
        if isinstance(data_type, T.StringType):
            target = target.try_cast("double")
        elif not isinstance(data_type, T.NumericType):
            raise ValueError(f"{name} needs a numeric column, {column!r} is {data_type.simpleString()}")
        elif name == "sum" and isinstance(data_type, T.IntegralType):
            target = target.cast("decimal(20,0)")
    return getattr(F, name)(target)


def _expression(df: DataFrame, name: str, argument: str) -> Column:
    """`name(argument)`; both the argument alone and the whole must be what they claim."""
    distinct, rest = re.fullmatch(r"(?is)\s*(distinct\s+)?(.*)", argument).groups()
    try:
        F.expr(f"struct({rest})")  # a complete list of expressions by itself
        if name == "count_distinct":
            name, distinct = "count", "DISTINCT "
        value = F.expr(f"{name}({'DISTINCT ' if distinct else ''}{rest})")
        df.agg(value)  # an aggregate over columns of this table
    except (ParseException, AnalysisException) as problem:
        told = str(problem).split("\n")[0]
        raise ValueError(f"{name}({argument}) is no aggregate of this table: {told}") from None
    return value


def as_result(value: Column) -> Column:
    """Any aggregate as a decimal; what has no such value becomes null and is left to its text form."""
    return value.cast("string").try_cast(RESULT_TYPE)


def _needs_own_pass(metric: Metric) -> bool:
    # An exact distinct count multiplies the rows of every aggregate it shares a
    # plan with, so it is planned by itself.
    return (metric.function or "").strip().lower() == "count_distinct" or bool(
        re.match(r"\s*distinct\s", metric.column or "", re.I) and metric.kind == "aggregate"
    )


def metric_column(df: DataFrame, metric: Metric) -> Column | None:
    """The aggregate behind a metric; None for a row count, which every pass has.

    Raises when the table has no such column, or not of a fitting type.
    """
    if metric.kind == "rows":
        return None
    if metric.kind == "nulls":
        return null_count(df, metric.column)
    if metric.kind == "in_list":
        return in_list_count(df, metric.column, metric.values)
    if metric.kind == "latest":
        return F.max(quoted(resolve(df, metric.column)).try_cast("timestamp"))
    if metric.kind == "aggregate":
        return kpi_value(df, metric.function, metric.column).cast("string")
    raise ValueError(f"unknown metric kind {metric.kind!r}")


# Which field of a metric row an aggregate fills.
_FIELD_OF = {
    "rows": None,
    "nulls": "unexpected_rows",
    "in_list": "unexpected_rows",
    "latest": "as_of_max",
    "aggregate": "value",
}


def metric_row_sql(check_id: int, side: str, known: Mapping[str, str]) -> str:
    """A metric row as a SQL struct; `known` gives the expressions of its filled fields."""
    filled = {"check_id": str(check_id), "side": f"'{side}'", **known}
    fields = (part.split(" ") for part in METRIC_SCHEMA.split(", "))
    return "named_struct({})".format(
        ", ".join(f"'{name}', CAST({filled.get(name, 'NULL')} AS {kind})" for name, kind in fields)
    )


Planned = tuple[Metric, Column | None]


def metric_passes(metrics: Sequence[Planned]) -> list[list[Planned]]:
    """Metrics of one table, put together by the pass over the table that takes them."""
    shared = [m for m in metrics if not _needs_own_pass(m[0])]
    alone = [m for m in metrics if _needs_own_pass(m[0])]
    passes = [shared[i : i + METRICS_PER_PASS] for i in range(0, len(shared), METRICS_PER_PASS)]
    return [*passes, *[[m] for m in alone]]


def one_pass(df: DataFrame, metrics: Sequence[Planned]) -> DataFrame:
    """Metric rows of one pass over a table.

    All metrics share one scan that reads only the named columns and one
    partial/final aggregate, whose exchange carries a single row per task.
    """
    measured = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[column.alias(f"m{i}") for i, (_, column) in enumerate(metrics) if column is not None],
    )
    rows = []
    for i, (metric, _) in enumerate(metrics):
        known = {"total_rows": "total_rows"}
        if _FIELD_OF[metric.kind]:
            known[_FIELD_OF[metric.kind]] = f"m{i}"
        if metric.kind == "aggregate":
            known |= {"value": f"try_cast(m{i} AS {RESULT_TYPE.simpleString()})", "value_text": f"m{i}"}
        rows.append(metric_row_sql(metric.check_id, metric.side, known))
    return measured.selectExpr(f"inline(array({', '.join(rows)}))")


def table_metrics(df: DataFrame, metrics: Sequence[Metric]) -> list[DataFrame]:
    """Long metric rows (`METRIC_SCHEMA`) of one table, one DataFrame per pass over it."""
    planned = [(m, metric_column(df, m)) for m in metrics]
    return [one_pass(df, p) for p in metric_passes(planned)]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """`table_name, row_count` for several tables in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def hours_since(latest: Column, as_of: Column) -> Column:
    """Signed hours from `latest` to `as_of`; a future time gives a negative number."""
    return (F.unix_micros(as_of) - F.unix_micros(latest)) / F.lit(3.6e9)

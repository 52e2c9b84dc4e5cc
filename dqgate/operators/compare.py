"""Comparisons of two results: source with destination, previous run with this run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqgate.functions.threshold import pair_status, pct_change, rerun_status
from dqgate.names import FAIL, PASS


def compared(df: DataFrame, previous: str, current: str, rule: str) -> DataFrame:
    """Adds `pct_change` and `status`; `rule` is `pair` or `rerun`."""
    status = {"pair": pair_status, "rerun": rerun_status}[rule]
    return df.withColumns(
        {"pct_change": pct_change(previous, current, rule == "rerun"), "status": status(previous, current)}
    )


def with_previous(
    current: DataFrame, state: DataFrame, keys: Sequence[str], value: str, alias: str
) -> DataFrame:
    """Current results with the stored value of the same key, null where there is none."""
    stored = state.select(*keys, F.col(value).alias(alias))
    return current.join(stored, list(keys), "left")


def paired(source: DataFrame, destination: DataFrame, key: str, value: str) -> DataFrame:
    """Source and destination results side by side, matched by check."""
    left = source.select(key, F.col(value).alias("source_result"))
    right = destination.select(key, F.col(value).alias("destination_result"))
    return left.join(right, key, "full")


def count_status_sql(rows: str) -> str:
    return f"CASE WHEN {rows} > 0 THEN '{PASS}' ELSE '{FAIL}' END"


def clean_status_sql(unexpected_rows: str) -> str:
    return f"CASE WHEN {unexpected_rows} = 0 THEN '{PASS}' ELSE '{FAIL}' END"


def freshness_status_sql(hours: str, threshold: str) -> str:
    return f"CASE WHEN {hours} < {threshold} THEN '{PASS}' ELSE '{FAIL}' END"


def count_status(rows: str) -> Column:
    """A row count fails only when there are no rows."""
    return F.expr(count_status_sql(rows))


def clean_status(unexpected_rows: str) -> Column:
    """A data-quality check passes when no row violates it."""
    return F.expr(clean_status_sql(unexpected_rows))


def freshness_status(hours: str, threshold: str) -> Column:
    """Fresh when fewer hours than the threshold have passed; no time at all fails."""
    return F.expr(freshness_status_sql(hours, threshold))

"""The change rule between a previous and a current result.

A change passes while it stays within +20 % and -5 %, after the percentage has
been truncated toward zero: +20.9 % and -5.9 % still pass. Source and destination
results lose their fractions before they are compared; results of two runs keep
them, so that shares and rates are compared too. All functions take the names of the
two result columns, or SQL expressions for them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqgate.names import FAIL, LOWER_LIMIT_PCT, PASS, UPPER_LIMIT_PCT


def whole_sql(value: str) -> str:
    """Drop the fraction, toward zero, without leaving the number's own type."""
    return f"(CASE WHEN {value} >= 0 THEN floor({value}) ELSE ceil({value}) END)"


def whole(value: Column) -> Column:
    return F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value))


def _raw_pct(previous: str, current: str, exact: bool) -> str:
    if exact:
        # One rounding only: 10 to 12.9 is 29 %, not 28.999.
        return f"try_divide(double({current} - {previous}) * 100, double({previous}))"
    prev, cur = whole_sql(previous), whole_sql(current)
    return f"(try_divide(double({cur} - {prev}), double({prev})) * 100)"


def pct_change_sql(previous: str, current: str, exact: bool = False) -> str:
    return f"try_cast({_raw_pct(previous, current, exact)} AS bigint)"


def _within_limits(previous: str, current: str, exact: bool) -> str:
    # Truncation toward zero makes "more than 20" mean 21 or above. Comparing
    # the double avoids overflow of very large ratios.
    pct = _raw_pct(previous, current, exact)
    return (
        f"CASE WHEN {pct} >= {UPPER_LIMIT_PCT + 1} OR {pct} <= -{LOWER_LIMIT_PCT + 1} "
        f"THEN '{FAIL}' ELSE '{PASS}' END"
    )


def rerun_status_sql(previous: str, current: str) -> str:
    first_run = f"({previous} IS NULL OR {previous} = 0)"
    return (
        f"CASE WHEN {current} IS NULL OR ({first_run} AND {current} = 0) THEN '{FAIL}' "
        f"WHEN {first_run} THEN '{PASS}' ELSE {_within_limits(previous, current, True)} END"
    )


def pair_status_sql(source: str, destination: str) -> str:
    return (
        f"CASE WHEN {source} IS NULL OR {destination} IS NULL THEN '{FAIL}' "
        f"WHEN {whole_sql(source)} = 0 AND {whole_sql(destination)} = 0 THEN '{PASS}' "
        f"WHEN {whole_sql(source)} = 0 THEN '{FAIL}' "
        f"ELSE {_within_limits(source, destination, False)} END"
    )


def pct_change(previous: str, current: str, exact: bool = False) -> Column:
    """Whole percent of change; null when there is no previous result or it is 0."""
    return F.expr(pct_change_sql(previous, current, exact))


def rerun_status(previous: str, current: str) -> Column:
    """Judge a result against the previous run.

    With no previous result, or a previous result of 0, there is nothing to
    compare with: the check fails only if the current result is 0.
    """
    return F.expr(rerun_status_sql(previous, current))


def pair_status(source: str, destination: str) -> Column:
    """Judge a destination result against its source result.

    An empty source passes only with an empty destination; a missing result on
    either side fails.
    """
    return F.expr(pair_status_sql(source, destination))

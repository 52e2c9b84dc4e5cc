"""Incremental pulls above a high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate.functions.columns import quoted, resolve


def rows_after(df: DataFrame, column: str, mark: Column | object) -> DataFrame:
    """Rows strictly above the mark; rows without a value are left out.

    The mark is brought to the column's type, so that a constant one reaches the
    file scan as a pushed filter.
    """
    name = resolve(df, column)
    bound = mark if isinstance(mark, Column) else F.lit(mark)
    return df.where(quoted(name) > bound.cast(df.schema[name].dataType))


def high_water_mark(target: DataFrame, column: str) -> Column | None:
    """Largest value already loaded, as a constant; None for an empty target.

    Only the one column is read, and one value comes back.
    """
    name = resolve(target, column)
    data_type = target.schema[name].dataType
    largest = F.max(quoted(name))
    if isinstance(data_type, T.TimestampType):
        micros = target.agg(F.unix_micros(largest).alias("mark")).first()["mark"]
        return None if micros is None else F.timestamp_micros(F.lit(micros))
    text = target.agg(largest.cast("string").alias("mark")).first()["mark"]
    return None if text is None else F.lit(text).cast(data_type)


def pull_new_rows(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows above the target's own high-water mark; all rows when it has none."""
    mark = high_water_mark(target, column)
    return source if mark is None else rows_after(source, column, mark)

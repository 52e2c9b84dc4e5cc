"""Measured sizes, for data that is to be sent to every executor."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate.functions.columns import quoted

# Most bytes that are sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: a fixed part per column, and the length of texts and nested values."""
    widths = []
    for name, field in zip(df.columns, df.schema.fields, strict=True):
        col = quoted(name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(col), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            widths.append(F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)))
    return reduce(add, widths, F.lit(16 + 16 * len(df.columns))).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Size of a DataFrame, by one aggregate over it."""
    return int(df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("n")).first()["n"])


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """`df` with a broadcast hint if its measured size allows, as it is otherwise."""
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df

"""Uniqueness of one column or of a compound key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqgate.functions.columns import quoted, resolve
from dqgate.functions.keys import compact_key


def key_names(keys: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def some_part(parts: Sequence[Column]) -> Column:
    return reduce(or_, [p.isNotNull() for p in parts])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as `n_rows`, over compact keys.

    Counts are combined within each task first, so a hot key does not travel.
    Keys that are null in every part are not keys and are left out.
    """
    names = key_names(keys)
    keyed = df.select(
        *[compact_key(df, resolve(df, k)).alias(n) for k, n in zip(keys, names, strict=True)]
    )
    return (
        keyed.where(some_part([F.col(n) for n in names]))
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def counted_stats(counts: DataFrame) -> DataFrame:
    """One row from `n_rows` per key: `unexpected_rows` (rows of repeated keys) and `unexpected_keys` (repeated keys)."""
    repeated = F.col("n_rows") > 1
    return counts.agg(
        F.coalesce(F.sum(F.when(repeated, F.col("n_rows"))), F.lit(0))
        .cast("bigint")
        .alias("unexpected_rows"),
        F.count_if(repeated).alias("unexpected_keys"),
    )


def uniqueness_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: `unexpected_rows` (rows of repeated keys) and `unexpected_keys` (repeated keys)."""
    return counted_stats(key_counts(df, keys))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their original values and `n_rows`."""
    cols = [quoted(resolve(df, k)) for k in keys]
    return (
        df.where(some_part(cols))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )

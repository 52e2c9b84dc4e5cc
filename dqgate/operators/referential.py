"""Foreign keys: every non-null fact key must exist in the dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate.functions import sizes
from dqgate.functions.columns import quoted, resolve

_KEY = "_fk"


def _key_columns(
    fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str
) -> tuple[Column, Column]:
    """Both keys in types that compare equal.

    Text meets other types as text, and whole numbers as bigint, so that both
    sides are partitioned alike. The rest is left to Spark's own coercion.
    """
    left, right = resolve(fact, fact_key), resolve(dim, dim_key)
    kinds = fact.schema[left].dataType, dim.schema[right].dataType
    columns = quoted(left), quoted(right)
    if kinds[0] == kinds[1]:
        return columns
    if all(isinstance(kind, T.IntegralType) for kind in kinds):
        return columns[0].cast("bigint"), columns[1].cast("bigint")
    if any(isinstance(kind, T.StringType) for kind in kinds):
        return columns[0].cast("string"), columns[1].cast("string")
    return columns


def _keys(df: DataFrame, key: Column) -> DataFrame:
    return df.select(key.alias(_KEY)).where(F.col(_KEY).isNotNull())


def missing_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact keys absent from the dimension, each with its number of fact rows.

    The fact side is counted per key before it is joined. A key that holds a
    third of the rows leaves each task as one row, and the join reuses the
    partitioning of that count. Catalyst chooses broadcast or sort-merge for
    the dimension from its size.
    """
    left, right = _key_columns(fact, fact_key, dim, dim_key)
    counted = _keys(fact, left).groupBy(_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(_keys(dim, right), _KEY, "left_anti").withColumnRenamed(
        _KEY, "missing_key"
    )


def foreign_key_stats(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """One row: `unexpected_rows` (orphan rows) and `unexpected_keys` (their distinct keys)."""
    return missing_keys(fact, fact_key, dim, dim_key).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("unexpected_rows"),
        F.count(F.lit(1)).alias("unexpected_keys"),
    )


def _match_rows(
    fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, how: str
) -> DataFrame:
    left, right = _key_columns(fact, fact_key, dim, dim_key)
    dim_keys = _keys(dim, right)
    rows = fact.withColumn(_KEY, left).where(F.col(_KEY).isNotNull())
    small = _small_keys(dim_keys)
    if small is not None:
        return rows.join(F.broadcast(small), _KEY, how).drop(_KEY)
    # One pass over the fact. A partition that a hot key fills is split by the adaptive skew
    # join: it can be, as semi and anti joins stream the fact, and as nothing stands
    # between the shuffles and the join.
    return rows.join(dim_keys.hint("merge"), _KEY, how).drop(_KEY).select(*fact.columns)


def _small_keys(dim_keys: DataFrame) -> DataFrame | None:
    """The dimension's keys if they may be broadcast, without repeats where that is what makes them fit."""
    if sizes.measured_bytes(dim_keys) <= sizes.BROADCAST_BYTES:
        return dim_keys
    distinct = dim_keys.distinct()
    return distinct if sizes.measured_bytes(distinct) <= sizes.BROADCAST_BYTES else None


def orphan_rows(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose key is not in the dimension; rows without a key are not orphans."""
    return _match_rows(fact, fact_key, dim, dim_key, "left_anti")


def valid_rows(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose key is in the dimension."""
    return _match_rows(fact, fact_key, dim, dim_key, "left_semi")

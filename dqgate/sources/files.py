"""Scans of paths and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_path(
    spark: SparkSession, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Whole table at a path; `fmt` may be any installed format, such as delta."""
    return spark.read.format(fmt).options(**options).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view known to the session's catalog."""
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a table for SQL. The name is a single part: views live in no schema."""
    if "." in name:
        raise ValueError(f"a view name has one part: {name!r}")
    df.createOrReplaceTempView(name)
    return df

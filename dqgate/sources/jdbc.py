"""Scans of a warehouse over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


@dataclass(frozen=True)
class Warehouse:
    """Where a warehouse is and how to log in; `options` are Spark JDBC options."""

    url: str
    driver: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader(self, spark: SparkSession) -> DataFrameReader:
        return spark.read.format("jdbc").options(**self.all_options())

    def all_options(self) -> dict[str, str]:
        driver = {"driver": self.driver} if self.driver else {}
        return {"url": self.url, **driver, **self.options}


def query_warehouse(spark: SparkSession, warehouse: Warehouse, query: str) -> DataFrame:
    """Run a whole query inside the warehouse and read only its result."""
    return warehouse.reader(spark).option("query", query).load()


def read_warehouse(
    spark: SparkSession,
    warehouse: Warehouse,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = 1,
) -> DataFrame:
    """A warehouse table.

    With a numeric, date or timestamp `partition_column` the table is read by
    `num_partitions` tasks over equal ranges of it. The range ends come from a
    min/max query that the warehouse answers itself; rows outside the ends, or
    without a value, still belong to the first or last range. Choose a column
    whose values are spread evenly, such as a running number: the ranges are of
    equal width, not of equal row count.
    """
    reader = warehouse.reader(spark).option("dbtable", table)
    if partition_column is None or num_partitions <= 1:
        return reader.load()
    low, high = query_warehouse(
        spark,
        warehouse,
        f"SELECT MIN({partition_column}) AS LOW_END, MAX({partition_column}) AS HIGH_END FROM {table}",
    ).first()
    if low is None:
        return reader.load()
    return (
        reader.option("partitionColumn", partition_column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(num_partitions))
        .load()
    )

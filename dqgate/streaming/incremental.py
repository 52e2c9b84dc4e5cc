"""The incremental pull as a stream: what has arrived since the last run, once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_path(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files arriving under a path, as a stream. The schema is stated, not inferred."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def append_available(
    rows: DataFrame,
    location: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append everything that has arrived, then stop.

    The checkpoint folder, which must be shared storage, remembers what has been
    loaded: a later call takes only newer files, and a call that was cut off is
    finished without loading anything twice.
    """
    return (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .partitionBy(*partition_by)
        .start(location)
    )

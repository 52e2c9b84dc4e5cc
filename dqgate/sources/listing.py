"""The data files of a table, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def data_files(spark: SparkSession, location: str) -> DataFrame:
    """`folder, file, bytes, modified` of each file below `location`, hidden ones aside.

    Only the listing is read: of a file no byte is. `folder` is the encoded name that
    `_metadata.file_path` has, without the file's own name.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    path = F.col("_metadata.file_path")
    return files.select(
        folder_of(path).alias("folder"),
        path.alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def folder_of(file_path):
    return F.regexp_replace(file_path, "/[^/]*$", "")


def decoded(spark: SparkSession, path: str) -> str:
    """An encoded name as readers and file systems take it."""
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)).toString()

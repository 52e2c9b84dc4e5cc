"""The check configuration file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate.functions.columns import quoted
from dqgate.schemas import CONFIG_COLUMNS

REQUIRED = ("PipelineName", "StageName", "Check_Status", "ValidationCheck")


def read_check_config(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Configured checks, all columns text, found by the names in the file's header.

    Their order does not matter, nor does case. Other columns are ignored, absent
    optional ones are null; absent required ones are an error before anything runs. Values
    may span lines and hold the delimiter inside double quotes; a double quote inside a
    value is written twice. An empty value is null.
    """
    stored = spark.read.options(header=True, delimiter=delimiter, multiLine=True, escape='"').csv(path)
    present = {c.strip().lower(): c for c in reversed(stored.columns)}
    missing = [c for c in REQUIRED if c.lower() not in present]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {stored.columns}")
    return stored.select(
        *[
            (quoted(present[c.lower()]) if c.lower() in present else F.lit(None).cast("string")).alias(c)
            for c in CONFIG_COLUMNS
        ]
    )

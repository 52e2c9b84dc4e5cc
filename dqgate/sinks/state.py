"""Results kept from run to run, for comparison with the next run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate.names import CAT_KPI_PRE_POST, CAT_PRE_POST
from dqgate.schemas import STATE_KEYS, STATE_SCHEMA
from dqgate.sinks.layers import merged, overwrite, path_exists, upsert


# What a stored result belongs to, besides its pipeline, stage, check and layer: KPIs have
# their own id, row counts their table. Used for writing and for looking up.
STATE_KEY_SQL = (
    f"CASE WHEN category = '{CAT_KPI_PRE_POST}' THEN coalesce(unique_id, table_name) ELSE table_name END"
)


def read_state(spark: SparkSession, location: str) -> DataFrame:
    """Stored results; empty before the first run."""
    if not path_exists(spark, location):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.parquet(location)


def latest_state(state: DataFrame) -> DataFrame:
    """One result per key: that of the latest run."""
    return state.groupBy(*STATE_KEYS).agg(
        F.max_by("result", "run_ts").alias("result"), F.max("run_ts").alias("run_ts")
    )


def state_of(check_result: DataFrame) -> DataFrame:
    """The results of a run that the next run compares with.

    A check without a result (an error, or an aggregate of nothing) leaves the
    stored value as it is.
    """
    reruns = F.col("category").isin(CAT_PRE_POST, CAT_KPI_PRE_POST)
    return latest_state(
        check_result.where(reruns & F.col("current_result").isNotNull())
        .select(
            "pipeline",
            "stage",
            "check_type",
            F.coalesce("layer", F.lit("")).alias("layer"),
            F.expr(STATE_KEY_SQL).alias("state_key"),
            F.col("current_result").alias("result"),
            F.col("created_at").alias("run_ts"),
        )
    )


def merged_state(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored results with those of this run put in; other keys survive."""
    return merged(stored, new, STATE_KEYS)


def save_state(spark: SparkSession, new: DataFrame, location: str) -> None:
    if path_exists(spark, location):
        upsert(spark, new, location, STATE_KEYS)
    else:
        overwrite(new, location)

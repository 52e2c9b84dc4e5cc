"""Writes that measure what they write: the checks of a new table without a second scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dqgate.operators.metrics import Metric, metric_column
from dqgate.schemas import METRIC_SCHEMA
from dqgate.sinks.layers import by_folder, write_options

_FIELD = {"rows": None, "nulls": "unexpected_rows", "in_list": "unexpected_rows", "latest": "as_of_max"}


def overwrite_observed(
    df: DataFrame, location: str, metrics: Sequence[Metric], fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace the table at `location`, and give the metric rows (`METRIC_SCHEMA`) of what was written.

    Row counts, nulls, unexpected values and latest times are observed in the writing tasks
    themselves, the last stage of the job: of a task that is repeated, one attempt counts. Raises
    before anything is written if a metric is of another kind or its column is missing.
    """
    other = [m.kind for m in metrics if m.kind not in _FIELD]
    if other:
        raise ValueError(f"cannot be observed in a write: {sorted(set(other))}")
    planned = [(i, m, metric_column(df, m)) for i, m in enumerate(metrics)]
    observation = Observation()
    counted = [F.count(F.lit(1)).alias("total_rows"), *[c.alias(f"m{i}") for i, _, c in planned if c is not None]]
    writer = by_folder(df, partition_by).observe(observation, *counted).write.format(fmt).mode("overwrite")
    writer.options(**write_options(fmt, overwriteSchema="true")).partitionBy(*partition_by).save(location)
    found = observation.get
    given = [(i, m, found["total_rows"], found.get(f"m{i}")) for i, m, _ in planned]
    rows = [
        (m.check_id, m.side, total, *[value if _FIELD[m.kind] == name else None for name in _NAMES[3:]]) for _, m, total, value in given
    ]
    return df.sparkSession.createDataFrame(rows, METRIC_SCHEMA)


_NAMES = [part.split(" ")[0] for part in METRIC_SCHEMA.split(", ")]

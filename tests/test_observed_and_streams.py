"""Writes that measure what they write, and keyed upserts from a stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dqgate.operators.metrics import Metric, table_metrics
from dqgate.sinks.observed import overwrite_observed
from dqgate.sources.files import read_path
from dqgate.streaming.incremental import stream_path
from dqgate.streaming.upserts import newest, upsert_available, upsert_batch
from tests.conftest import rows

METRICS = [Metric(5, "rows"), Metric(1, "nulls", "name"), Metric(2, "in_list", "id", ("1", "x")), Metric(3, "latest", "ts"), Metric(4, "nulls", "id", side="dest")]
SCHEMA = "id int, name string, ts timestamp"


def stamped(spark, values):
    return spark.createDataFrame(values, "id int, name string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize("partition_by", [[], ["name"]])
def test_a_write_measures_what_a_scan_would(spark, place, partition_by):
    df = stamped(spark, [(1, "a", "2024-01-01"), (1, None, None), (2, "b", "2024-02-01"), (None, "b", "2023-01-01")]).repartition(3)
    found = overwrite_observed(df, place, METRICS, partition_by=partition_by)
    (expected,) = table_metrics(read_path(spark, place).select(*df.columns), METRICS)
    assert rows(found) == rows(expected)


def test_the_write_reads_its_source_once(spark, place, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(counted, "id long")
    found = overwrite_observed(df, place, [Metric(0, "rows"), Metric(1, "nulls", "id")])
    assert [r.total_rows for r in found.collect()] == [100, 100] and calls.value == 100


def test_empty_tables_and_what_cannot_be_observed(spark, place):
    empty = stamped(spark, []).select("id", "name", "ts")
    found = {r.check_id: r for r in overwrite_observed(empty, place, METRICS).collect()}
    assert {r.total_rows for r in found.values()} == {0} and found[3].as_of_max is None
    for metric in (Metric(0, "aggregate", "id", function="sum"), Metric(0, "nulls", "nowhere")):
        with pytest.raises(ValueError):
            overwrite_observed(spark.range(5), place, [metric])
    assert read_path(spark, place).columns == ["id", "name", "ts"]


# ---- streams ---------------------------------------------------------------


def test_the_newest_row_of_a_key_counts(spark):
    df = stamped(spark, [(1, "old", "2024-01-01"), (1, "new", "2024-01-02"), (1, "none", None), (2, "only", None), (None, "x", None), (None, "x", None)])
    assert sorted((r.id or 0, r.name) for r in newest(df, ["id"], "ts").collect()) == [(0, "x"), (0, "x"), (1, "new"), (2, "only")]


def test_stream_equals_batch_and_loads_each_file_once(spark, tmp_path):
    place, checkpoint, source = (str(tmp_path / x) for x in ("target", "progress", "source"))
    stamped(spark, [(i, "old", "2024-01-01") for i in range(20)]).write.parquet(place)
    expected = {i: "old" for i in range(20)}
    for turn, ids in enumerate([range(5, 10), range(8, 25), []]):
        if ids:
            stamped(spark, [(i, f"turn{turn}-{n}", f"2024-02-0{n}") for i in ids for n in (1, 3, 2)]).repartition(3).write.mode("append").parquet(source)
        expected |= {i: f"turn{turn}-3" for i in ids}
        upsert_available(stream_path(spark, source, SCHEMA), place, checkpoint, ["id"], "ts").awaitTermination()
        assert {r.id: r.name for r in read_path(spark, place).collect()} == expected
        assert read_path(spark, place).count() == len(expected)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    place, checkpoint = str(tmp_path / "target"), str(tmp_path / "progress")
    stamped(spark, [(1, "old", None)]).write.parquet(place)
    batch = stamped(spark, [(1, "new", "2024-01-01"), (None, "no key", None)])
    assert upsert_batch(batch, 0, place, checkpoint, ["id"], "ts")
    before = rows(read_path(spark, place))
    assert not upsert_batch(batch, 0, place, checkpoint, ["id"], "ts")
    assert rows(read_path(spark, place)) == before and len(before) == 2
    assert upsert_batch(stamped(spark, [(1, "newer", "2024-01-02")]), 1, place, checkpoint, ["id"], "ts")
    assert {r.name for r in read_path(spark, place).collect()} == {"newer", "no key"}

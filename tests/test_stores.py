"""Sinks, incremental pulls, history and the stream form."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqgate.functions import sizes
from dqgate.schemas import AUDIT_SCHEMA, STATE_KEYS
from dqgate.session import scratch_dir
from dqgate.sinks import history, layers
from dqgate.sinks import jdbc as warehouse_sink
from dqgate.sinks.state import merged_state, read_state, save_state
from dqgate.sources import incremental, jdbc
from dqgate.sources.files import read_path, register_view
from dqgate.streaming.incremental import append_available, stream_path
from tests.conftest import rows
from tests.test_run import state_of

TARGET = "k int, a string, b int"
SOURCE = "k int, a string"


def folders(place):
    parent, name = os.path.split(place)
    return sorted(f for f in os.listdir(parent) if f.startswith(name))


def test_overwrite_replaces_rows_and_columns(spark, place):
    layers.overwrite(spark.range(5), place)
    layers.overwrite(spark.range(2).select(F.col("id").alias("x"), F.lit("y").alias("y")), place)
    assert read_path(spark, place).columns == ["x", "y"]
    assert read_path(spark, place).count() == 2


def test_append_keeps_what_is_there(spark, place):
    layers.append(spark.range(2), place)
    layers.append(spark.range(2, 5), place)
    assert rows(read_path(spark, place)) == [(i,) for i in range(5)]


@pytest.mark.parametrize("small", [True, False])
def test_merge_updates_inserts_and_keeps(spark, small):
    target = spark.createDataFrame([(1, "x", 10), (2, "y", 20), (None, "n", 30)], TARGET)
    source = spark.createDataFrame([(2, "new"), (3, "added"), (None, "null key")], SOURCE)
    assert rows(layers.merged(target, source, ["k"], small)) == sorted(
        [(1, "x", 10), (2, "new", 20), (3, "added", None), (None, "n", 30), (None, "null key", None)], key=repr
    )


@pytest.mark.parametrize("small", [True, False])
def test_merge_can_set_a_value_to_null(spark, small):
    target = spark.createDataFrame([(1, "x", 10)], TARGET)
    source = spark.createDataFrame([(1, None)], SOURCE)
    assert rows(layers.merged(target, source, ["k"], small)) == [(1, None, 10)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.text("ab", max_size=2)), max_size=15),
    st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 3)), st.text("cd", max_size=2), max_size=8),
)
def test_both_ways_of_merging_agree_with_a_dictionary(spark, old, changes):
    old = {(k, j): v for k, j, v in old}
    target = spark.createDataFrame([(*k, v) for k, v in old.items()], "k int, j int, v string")
    source = spark.createDataFrame([(*k, v) for k, v in changes.items()], "k int, j int, v string")
    expected = sorted(((*k, v) for k, v in {**old, **changes}.items()), key=repr)
    for small in (True, False):
        once = layers.merged(target, source, ["k", "j"], small)
        assert rows(once) == expected
    assert rows(layers.merged(once, source, ["k", "j"])) == expected


@pytest.mark.parametrize("small", [True, False])
def test_a_key_shared_by_many_target_rows(spark, small):
    target = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    source = spark.createDataFrame([(7, "new"), (-1, "added")], "k bigint, v string")
    got = {r.v: r.n for r in layers.merged(target, source, ["k"], small).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {"x": 1999, "new": 1001, "added": 1}


def test_large_merges_stream_the_target(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(100).select("id", F.lit("x").alias("v"))
        plan = layers.merged(target, target, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftOuter" in plan and "LeftAnti" in plan and "FullOuter" not in plan


def test_small_changes_do_not_shuffle_the_target(spark):
    target = spark.range(1000).select("id", F.lit("x").alias("v"))
    source = spark.range(5).select("id", F.lit("y").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = layers.merged(target, source, ["id"], True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftOuter, BuildRight" in plan
    assert plan.count("SortMergeJoin") <= 1  # only the changes against their own matches


def test_upsert_rejects_repeated_keys(spark, place):
    layers.overwrite(spark.createDataFrame([(1, "x", 1)], TARGET), place)
    source = spark.createDataFrame([(2, "a"), (2, "b")], SOURCE)
    with pytest.raises(ValueError, match="repeated keys"):
        layers.upsert(spark, source, place, ["k"])
    assert rows(read_path(spark, place)) == [(1, "x", 1)]


def test_upsert_inserts_rows_without_a_key(spark, place):
    layers.overwrite(spark.createDataFrame([(1, "x", 1), (None, "n", 2)], TARGET), place)
    source = spark.createDataFrame([(None, "a"), (None, "b")], SOURCE)
    layers.upsert(spark, source, place, ["k"])
    assert read_path(spark, place).where("k IS NULL").count() == 3


def test_upsert_rejects_columns_the_target_lacks(spark, place):
    layers.overwrite(spark.createDataFrame([(1, "x", 1)], TARGET), place)
    with pytest.raises(ValueError, match="missing in the target"):
        layers.upsert(spark, spark.createDataFrame([(1, 2)], "k int, zz int"), place, ["k"])


@pytest.mark.parametrize("limit", [sizes.BROADCAST_BYTES, -1])
def test_upsert_keeps_types_and_leaves_no_copies(spark, place, monkeypatch, limit):
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", limit)
    layers.overwrite(spark.createDataFrame([(1, "x", 10)], TARGET), place)
    wider = spark.createDataFrame([(1, "y"), (2, "z")], "k bigint, a string")
    layers.upsert(spark, wider, place, ["k"])
    df = read_path(spark, place)
    assert df.dtypes == [("k", "int"), ("a", "string"), ("b", "int")]
    assert rows(df) == [(1, "y", 10), (2, "z", None)]
    assert folders(place) == ["table"]


def test_a_failed_upsert_leaves_the_table(spark, place):
    layers.overwrite(spark.createDataFrame([(1, "x", 10)], TARGET), place)
    source = spark.range(1).select(
        F.lit(1).alias("k"), F.when(F.rand() >= 0, F.raise_error(F.lit("broken"))).cast("string").alias("a")
    )
    with pytest.raises(Exception, match="broken"):
        layers.upsert(spark, source, place, ["k"])
    assert rows(read_path(spark, place)) == [(1, "x", 10)]


PARTED = "p string, k int, v string"


@pytest.mark.parametrize("partition_by", [["p"], []])
def test_partitioned_upsert_rewrites_only_what_it_touches(spark, place, partition_by):
    old = [("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), (None, 1, "x")]
    layers.overwrite(spark.createDataFrame(old, PARTED), place, partition_by=["p"])
    before = {f: os.listdir(f"{place}/{f}") for f in ("p=a", "p=c")}
    source = spark.createDataFrame([("b", 1, "new"), ("b", 2, "added"), ("d", 1, "added"), (None, 1, "added")], PARTED)
    layers.upsert(spark, source, place, ["p", "k"], partition_by=partition_by)
    assert rows(read_path(spark, place).select("p", "k", "v")) == sorted(
        [("a", 1, "x"), ("b", 1, "new"), ("b", 2, "added"), ("c", 1, "x"), ("d", 1, "added"),
         (None, 1, "x"), (None, 1, "added")], key=repr,
    )
    assert before == {f: os.listdir(f"{place}/{f}") for f in ("p=a", "p=c")}
    assert folders(place) == ["table"]


def test_upsert_by_two_partition_columns(spark, place):
    schema = "p string, q int, k int, v string"
    layers.overwrite(spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "x")], schema), place, partition_by=["p", "q"])
    source = spark.createDataFrame([("a", 2, 1, "new"), ("b", 1, 1, "added")], schema)
    layers.upsert(spark, source, place, ["p", "q", "k"], partition_by=["p", "q"])
    assert rows(read_path(spark, place).select("p", "q", "k", "v")) == [
        ("a", 1, 1, "x"), ("a", 2, 1, "new"), ("b", 1, 1, "added"),
    ]


# ---- state -----------------------------------------------------------------


def test_state_replaces_by_key_and_keeps_the_rest(spark, place):
    assert read_state(spark, place).count() == 0
    old = state_of(spark, ("s", "Bronze", "t", "1"), ("s", "Silver", "t", "2"))
    new = state_of(spark, ("s", "Bronze", "t", "3"), ("s", "Bronze", "u", "4"))
    save_state(spark, old, place)
    save_state(spark, new, place)
    got = {(r.layer, r.state_key): float(r.result) for r in read_state(spark, place).collect()}
    assert got == {("Bronze", "t"): 3.0, ("Silver", "t"): 2.0, ("Bronze", "u"): 4.0}
    assert merged_state(old, new).groupBy(*STATE_KEYS).count().where("count > 1").count() == 0


# ---- incremental pull ------------------------------------------------------


def test_rows_after_is_strict_and_drops_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "n int")
    assert rows(incremental.rows_after(df, "n", 2)) == [(3,)]
    assert rows(incremental.rows_after(df, "n", "2")) == [(3,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint", "decimal(10,2)", "double", "string"])
def test_high_water_mark_comes_back_exactly(spark, kind):
    if kind in ("timestamp", "timestamp_ntz", "date"):
        values = ["2024-01-15 00:00:00.000001", "2024-01-16 10:11:12.123456", "2024-01-17 00:00:00"]
    else:
        values = ["1", "2", "3"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast(kind))
    middle = df.where(F.col("v") <= F.lit(values[1]).cast(kind))
    assert incremental.pull_new_rows(df, middle, "v").count() == 1
    assert incremental.pull_new_rows(df, df, "v").count() == 0
    assert incremental.pull_new_rows(df, df.where("false"), "v").count() == 3


def test_mark_is_pushed_to_the_scan(spark, sf_dir):
    events = read_path(spark, f"{sf_dir}/events.parquet")
    mark = incremental.high_water_mark(events.where("event_id < 500"), "ts")
    plan = incremental.rows_after(events, "ts", mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan


def test_stream_loads_each_file_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / p) for p in ("source", "target", "progress"))
    spark.range(5).write.parquet(source)
    schema = spark.range(1).schema

    def load():
        arriving = stream_path(spark, source, schema).where("id > 1")
        append_available(arriving, target, progress).awaitTermination()
        return rows(read_path(spark, target))

    assert load() == [(2,), (3,), (4,)]
    assert load() == [(2,), (3,), (4,)]
    spark.range(5, 7).write.mode("append").parquet(source)
    assert load() == [(2,), (3,), (4,), (5,), (6,)]


# ---- history ---------------------------------------------------------------


def audit(spark, *moments):
    df = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz")
    return df.select(
        *[
            (F.col("m") if f.name == "CRTD_TM" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in AUDIT_SCHEMA.fields
        ]
    )


def test_purge_drops_old_days_and_rewrites_the_day_of_the_limit(spark, place):
    as_of = dt.datetime(2024, 2, 10, 12)
    limit = as_of - dt.timedelta(days=35)
    hour = dt.timedelta(hours=1)
    moments = [limit - 40 * hour, limit - hour, limit, limit + hour, as_of]
    history.append_history(audit(spark, *moments), place)
    kept = [m for m in moments if m >= limit]
    assert history.retained(history.read_history(spark, place), as_of).count() == len(kept)
    history.purge_history(spark, place, as_of)
    assert sorted(r.CRTD_TM for r in history.read_history(spark, place).collect()) == kept
    assert not os.path.exists(f"{place}/crtd_day={(limit - 40 * hour).date()}")
    history.purge_history(spark, place, as_of)
    assert history.read_history(spark, place).count() == len(kept)
    assert folders(place) == ["table"]


def test_history_scan_prunes_days(spark, place):
    history.append_history(audit(spark, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)), place)
    assert read_path(spark, place).where("crtd_day = date'2024-01-02'").count() == 1
    assert history.read_history(spark, place).columns == AUDIT_SCHEMA.names


# ---- warehouse and views ---------------------------------------------------

WAREHOUSE = jdbc.Warehouse("jdbc:derby:memory:tests;create=true", "org.apache.derby.jdbc.EmbeddedDriver")


def test_partitioned_read_covers_nulls_and_all_ranges(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("n"))
    warehouse_sink.overwrite_table(df, WAREHOUSE, "NUMBERS")
    read = jdbc.read_warehouse(spark, WAREHOUSE, "NUMBERS", '"n"', 4)
    assert read.rdd.getNumPartitions() == 4
    assert rows(read) == rows(df)
    warehouse_sink.overwrite_table(df.where("false"), WAREHOUSE, "NOTHING")
    assert jdbc.read_warehouse(spark, WAREHOUSE, "NOTHING", '"n"', 4).count() == 0


def test_truncate_load_keeps_the_definition(spark):
    name = "KEPT"
    warehouse_sink.overwrite_table(spark.range(3).select(F.col("id").cast("decimal(20,4)")), WAREHOUSE, name)
    warehouse_sink.truncate_load_table(spark.range(2).select(F.col("id").cast("decimal(20,4)")), WAREHOUSE, name)
    read = jdbc.read_warehouse(spark, WAREHOUSE, name)
    assert read.dtypes == [("id", "decimal(20,4)")] and read.count() == 2


def test_history_in_a_warehouse(spark):
    df = audit(spark, dt.datetime(2024, 1, 1, 2, 3, 4))
    history.append_history_table(df, WAREHOUSE, "AUDIT_ROWS")
    history.append_history_table(df, WAREHOUSE, "AUDIT_ROWS")
    read = history.read_history_table(spark, WAREHOUSE, "AUDIT_ROWS")
    assert read.columns == AUDIT_SCHEMA.names and read.count() == 2


def test_view_names_have_one_part(spark):
    with pytest.raises(ValueError, match="one part"):
        register_view(spark.range(1), "default.t")


def test_scratch_folders_are_in_the_shared_folder(spark):
    a, b = scratch_dir(spark), scratch_dir(spark)
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_upsert_computes_its_source_once(spark, place):
    layers.overwrite(spark.createDataFrame([(1, "x")], "k int, v string"), place)
    seen = spark.sparkContext.accumulator(0)

    def noted(v):
        seen.add(1)
        return v

    source = spark.range(1, 4).select(F.col("id").cast("int").alias("k"), F.udf(noted)(F.lit("new")).alias("v"))
    layers.upsert(spark, source, place, ["k"])
    assert rows(read_path(spark, place)) == [(1, "new"), (2, "new"), (3, "new")]
    assert seen.value == 3


def test_upsert_touches_more_partitions_than_a_list_should_hold(spark, place):
    n = 1500
    table = spark.range(n).select(F.col("id").alias("p"), F.lit(1).alias("k"), F.lit("old").alias("v"))
    layers.overwrite(table.coalesce(1), place, partition_by=["p"])
    source = spark.range(n).select(F.col("id").alias("p"), F.lit(1).alias("k"), F.lit("new").alias("v"))
    layers.upsert(spark, source, place, ["p", "k"], partition_by=["p"])
    got = read_path(spark, place)
    assert got.count() == n and got.where("v <> 'new'").isEmpty()

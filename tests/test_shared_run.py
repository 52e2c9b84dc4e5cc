"""One plan over all stages, runs that go on where they were cut off, and checks inside the warehouse."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.operators import warehouse_metrics as wm
from dqgate.operators.metrics import Metric, table_metrics
from dqgate.plans import batch
from dqgate.plans import run as run_module
from dqgate.plans.batch import Output, run_and_save
from dqgate.plans.run import plan_run, prepare_run
from dqgate.schemas import RESULT_SCHEMA
from dqgate.sinks.history import read_history
from dqgate.sources.jdbc import Warehouse
from dqgate.sources.locations import LayerStore, Locations
from tests.conftest import rows
from tests.test_run import CTX, NOWHERE, config, on

STAGES = (n.STAGE_BRONZE, n.STAGE_SILVER, n.STAGE_GOLD, n.STAGE_SYNAPSE)


def stored(spark, output, stage):
    return spark.read.schema(RESULT_SCHEMA).parquet(output.stage("P", stage) + "/check_result")


@pytest.fixture
def tables(spark, tmp_path):
    for name in ("t", "u"):
        spark.range(10).select("id", F.when(F.col("id") > 3, F.col("id")).alias("a")).write.parquet(str(tmp_path / name))
    layer = LayerStore(str(tmp_path))
    return Locations(layers={"Bronze": layer, "Silver": layer, "Gold": layer})


def at(name, check, stage, **more):
    place = {"DestinationLocationType": n.LOCATION_PATH, "DestinationTableLocation": f"/{name}", "RowCountTableLocation": f"/{name}"}
    return on(name, check, StageName=stage, **place, **more)


def test_a_table_in_four_stages_is_scanned_once(spark, tables, tmp_path):
    entries = [at("t", check, stage, columns_list="a") for stage in STAGES for check in (n.ROW_COUNT, n.NULL)]
    planned = prepare_run(spark, config(spark, *entries), tables)
    assert len(planned.frames) == 1
    plan = planned.frames[0].rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    output = Output(str(tmp_path / "out"))
    gate = run_and_save(spark, config(spark, *entries), tables, CTX, output).collect()
    assert {r.stage for r in gate} == set(STAGES)
    for stage in STAGES:
        alone = plan_run(spark, config(spark, *entries), tables, CTX, stage=stage)
        assert rows(stored(spark, output, stage).drop("check_id")) == rows(alone.drop("check_id"))
    assert read_history(spark, output.history).count() == 8


def test_a_run_that_was_cut_off_goes_on(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "FRAMES_PER_UNIT", 1)
    cfg = config(spark, at("t", n.NULL, n.STAGE_BRONZE, columns_list="a"), at("u", n.NULL, n.STAGE_SILVER, columns_list="a"))
    output, real, made = Output(str(tmp_path / "out")), batch.overwrite, []

    def killed(df, location, *more):
        if "_runs" in location:
            if made and len(made) < 2:
                made.append("killed")
                raise KeyboardInterrupt
            made.append(location)
        real(df, location, *more)

    monkeypatch.setattr(batch, "overwrite", killed)
    with pytest.raises(KeyboardInterrupt):
        run_and_save(spark, cfg, tables, CTX, output, at_once=1)
    first = made[0]
    gate = run_and_save(spark, cfg, tables, CTX, output, at_once=1).collect()
    assert len(gate) == 2 and made.count(first) == 1 and len(made) == 3
    assert [r.unexpected_rows for s in (n.STAGE_BRONZE, n.STAGE_SILVER) for r in stored(spark, output, s).collect()] == [4, 4]
    assert not list((tmp_path / "out" / "_runs").iterdir())
    # A finished run that is repeated computes anew.
    run_and_save(spark, cfg, tables, CTX, output, at_once=1)
    assert made.count(first) == 2 and read_history(spark, output.history).count() == 2


def test_another_configuration_takes_nothing_from_an_earlier_attempt(spark, tables, tmp_path, monkeypatch):
    output, real = Output(str(tmp_path / "out")), batch.append_history
    monkeypatch.setattr(batch, "append_history", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        run_and_save(spark, config(spark, at("t", n.NULL, n.STAGE_BRONZE, columns_list="a")), tables, CTX, output)
    monkeypatch.setattr(batch, "append_history", real)
    run_and_save(spark, config(spark, at("t", n.NULL, n.STAGE_BRONZE, columns_list="id")), tables, CTX, output)
    assert [r.unexpected_rows for r in stored(spark, output, n.STAGE_BRONZE).collect()] == [0]


def test_jobs_side_by_side_lose_only_the_broken_table(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "FRAMES_PER_UNIT", 1)
    spark.sql("SELECT raise_error('broken file') AS id").createOrReplaceTempView("broken_too")
    cfg = config(spark, on("broken_too", n.NULL, columns_list="id"), *(at(t, n.NULL, n.STAGE_BRONZE, columns_list="a") for t in "tu"))
    output = Output(str(tmp_path / "out"))
    run_and_save(spark, cfg, tables, CTX, output, at_once=3)
    got = sorted((r.table_name, r.status) for r in stored(spark, output, n.STAGE_BRONZE).collect())
    assert got == [("broken_too", "Error"), ("t", "Fail"), ("u", "Fail")]


# ---- checks inside the warehouse: the same SQL, answered by a view instead ----


@pytest.fixture
def warehouse(spark, monkeypatch):
    values = [
        (1, "it's", dt.date(2024, 1, 1), dt.datetime(2024, 1, 2, 3), 1.5),
        (None, None, None, dt.datetime(2024, 1, 5), None),
        (3, "b", dt.date(2024, 2, 1), None, 2.5),
        (3, "B", None, None, float("nan")),
    ]
    spark.createDataFrame(values, "`the id` int, name string, day date, ts timestamp, x double").createOrReplaceTempView("stock")
    spark.sql("SELECT * FROM stock WHERE false").createOrReplaceTempView("no_stock")
    asked = []

    def answered(session, _, sql):
        asked.append(sql)
        return session.sql(sql)

    monkeypatch.setattr(wm, "query_warehouse", answered)
    monkeypatch.setattr(wm, "dialect_quote", lambda *_: lambda name: f"`{name}`")
    monkeypatch.setattr(run_module, "load_table", lambda session, kind, location, *_: session.table(location))
    return asked


METRICS = [
    Metric(0, "rows"),
    Metric(1, "nulls", "THE ID"),
    Metric(2, "in_list", "the id", ("3", "x", "1.5", " 1 ")),
    Metric(3, "in_list", "name", ("it's", "B", "zz")),
    Metric(4, "in_list", "day", ("2024-02-01", "no day")),
    Metric(5, "latest", "ts"),
    Metric(6, "nulls", "x"),
    Metric(7, "in_list", "the id", ("none",)),
    Metric(8, "latest", "day"),
]


@pytest.mark.parametrize("name", ["stock", "no_stock"])
def test_the_warehouse_gives_what_spark_would(spark, warehouse, name):
    table = spark.table(name)
    assert all(wm.pushable(table.schema, m) for m in METRICS)
    ((taken, got),) = wm.warehouse_passes(spark, Warehouse("jdbc:none"), table, name, METRICS)
    (expected,) = table_metrics(table, METRICS)
    assert taken == METRICS and rows(got) == rows(expected)
    assert len(warehouse) == 1 and spark.sql(warehouse[0]).count() == 1


def test_what_a_warehouse_may_see_otherwise_stays_in_spark(spark, warehouse):
    schema = spark.table("stock").schema
    kept = [Metric(0, "in_list", "x", ("1.5",)), Metric(1, "latest", "name"), Metric(2, "in_list", "name", ("a\\b",)), Metric(3, "aggregate", "x", function="sum")]
    assert not any(wm.pushable(schema, m) for m in kept)


def test_many_metrics_take_several_queries(spark, warehouse):
    passes = wm.warehouse_passes(spark, Warehouse("jdbc:none"), spark.table("stock"), "stock", METRICS * 10)
    assert [len(taken) for taken, _ in passes] == [60, 30] and len(warehouse) == 2


def test_checks_of_a_warehouse_table_transfer_one_row(spark, warehouse):
    there = {"DestinationLocationType": n.LOCATION_WAREHOUSE}
    entries = [
        on("stock", n.ROW_COUNT, **there),
        on("stock", n.NULL, columns_list="the id,name", **there),
        on("stock", n.UNEXPECTED, columns_list="the id", unexpected_list="3", **there),
        on("stock", n.UNEXPECTED, columns_list="x", unexpected_list="2.5", **there),
        on("stock", n.SLA, columns_list="ts", SLAThreshold="1", **there),
    ]
    places = Locations(warehouse=Warehouse("jdbc:none"))
    cfg = config(spark, *entries)
    planned = prepare_run(spark, cfg, places)
    assert len(warehouse) == 1 and len(planned.frames) == 2  # the list of doubles stays in Spark
    in_spark = config(spark, *({**e, "DestinationLocationType": n.LOCATION_CATALOG} for e in entries))
    assert rows(plan_run(spark, cfg, places, CTX)) == rows(plan_run(spark, in_spark, NOWHERE, CTX))


def test_names_are_written_as_the_warehouse_writes_them(spark):
    quote = wm.dialect_quote(spark, Warehouse("jdbc:mysql://none"))
    assert quote("a b") == "`a b`"
    assert wm.dialect_quote(spark, Warehouse("jdbc:postgresql://none"))("a b") == '"a b"'

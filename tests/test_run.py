"""Configured runs end to end, with the decisions taken where intent was unclear."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.plans import batch, results
from dqgate.plans.batch import Output, run_and_save
from dqgate.plans.run import RunContext, collect_items, plan_run, prepare_run
from dqgate.schemas import RESULT_SCHEMA, STATE_SCHEMA
from dqgate.sinks.history import read_history, read_history_table
from dqgate.sinks.state import read_state
from dqgate.sources.jdbc import Warehouse
from dqgate.sources.locations import LayerStore, Locations, RegisteredTable, abfss_store, load_table
from tests.conftest import rows
from tests.test_config import config
from workload import demo

AS_OF = dt.datetime(2024, 1, 31, 6)
CTX = RunContext(as_of=AS_OF, job_id=1, task_id=2, created_by="t", run_id="r")
NOWHERE = Locations()


def view(spark, name, rows, schema):
    spark.createDataFrame(rows, schema).createOrReplaceTempView(name)


def on(view_name, check, **more):
    return {
        "ValidationCheck": check,
        "DestinationLocationType": n.LOCATION_CATALOG,
        "DestinationTableName": view_name,
        "DestinationTableLocation": view_name,
        "RowCountTableName": view_name,
        "RowCountTableLocation": view_name,
        **more,
    }


def run(spark, *entries, state=None, locations=NOWHERE):
    return plan_run(spark, config(spark, *entries), locations, CTX, state).orderBy("check_id").collect()


@pytest.fixture
def people(spark):
    view(spark, "people", [(1, "a", 1), (2, None, 9), (None, "b", 9)], "id int, name string, boss int")
    view(spark, "nobody", [], "id int, ts timestamp")


def test_result_has_the_stated_schema(spark, people):
    df = plan_run(spark, config(spark, on("people", n.ROW_COUNT)), NOWHERE, CTX)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RESULT_SCHEMA]


def test_no_active_checks_give_an_empty_result(spark):
    assert run(spark, {**on("people", n.NULL), "Check_Status": "no"}) == []


def test_one_bad_check_does_not_stop_the_others(spark, people):
    got = run(
        spark,
        on("people", n.NULL, columns_list="id"),
        on("missing_view", n.NULL, columns_list="id"),
        on("people", n.NULL, columns_list="no_such_column"),
        on("people", n.NULL, columns_list="id", DestinationLocationType="FTP"),
        on("people", n.NULL),
        on("people", "Typo"),
    )
    by_error = {(r.table_name, r.column_name): r for r in got if r.status == n.ERROR}
    assert len(by_error) + 1 == len(got) - 1  # two of the errors concern the same column
    assert sorted(r.status for r in got) == ["Error"] * 5 + ["Fail"]
    texts = " ".join(r.error for r in got if r.error)
    for part in ("missing_view", "no_such_column", "FTP", "columns_list is empty", "Typo"):
        assert part in texts


def test_foreign_key_runs_and_is_recorded_everywhere(spark, people):
    entry = on(
        "people", n.FOREIGN_KEY, SourceTableName="people", SourceTableLocation="people",
        columns_list="boss->id", IsStageDependency="1",
    )
    df = plan_run(spark, config(spark, entry), NOWHERE, CTX)
    (row,) = df.collect()
    assert (row.status, row.unexpected_rows, row.unexpected_keys, row.total_rows) == ("Fail", 2, 1, 3)
    assert results.detail(df, n.CAT_FOREIGN_KEY).first()["Validation_Result"] == "Fail"
    assert results.summary_by_category(df).first()["Failed"] == 1
    audit = results.audit_history(df).first()
    assert (audit.VLDTN_CHCK_TYP, audit.VLDTN_RSLT, audit.ON_STG_DPND) == (n.FOREIGN_KEY, "Fail", 1)


def test_a_null_in_the_dimension_hides_no_orphan(spark):
    view(spark, "f", [(1,), (5,)], "k int")
    view(spark, "d", [(1,), (None,)], "k int")
    (row,) = run(spark, on("d", n.FOREIGN_KEY, SourceTableName="f", SourceTableLocation="f", columns_list="k"))
    assert (row.status, row.unexpected_rows) == ("Fail", 1)


def sla(spark, moment, threshold):
    view(spark, "stamped", [(moment,)] if moment else [], "ts timestamp_ntz")
    (row,) = run(spark, on("stamped", n.SLA, columns_list="ts", SLAThreshold=str(threshold)))
    return row


def test_freshness_uses_its_own_threshold_and_signed_hours(spark):
    before = AS_OF - dt.timedelta(hours=10)
    assert sla(spark, before, 12).status == "Pass"
    assert sla(spark, before, 10).status == "Fail"  # exactly the threshold is too late
    assert float(sla(spark, before, 12).current_result) == 10.0
    future = sla(spark, AS_OF + dt.timedelta(hours=1), 24)
    assert (float(future.current_result), future.status) == (-1.0, "Pass")
    assert sla(spark, None, 24).status == "Fail"


def test_freshness_is_audited_with_its_flag(spark):
    view(spark, "stamped", [(AS_OF,)], "ts timestamp_ntz")
    df = plan_run(
        spark,
        config(
            spark,
            on("stamped", n.SLA, columns_list="ts", SLAThreshold="1", IsStageDependency="1"),
            on("stamped", n.NULL, columns_list="ts", IsStageDependency="0"),
        ),
        NOWHERE,
        CTX,
    )
    flags = {r.VLDTN_CHCK_TYP: r.ON_STG_DPND for r in results.audit_history(df).collect()}
    assert flags == {n.SLA: 1, n.NULL: 0}


def test_summary_counts_tables_not_items(spark, people):
    df = plan_run(
        spark,
        config(
            spark,
            on("people", n.UNEXPECTED, columns_list="id,name", unexpected_list="7,,zz"),
            on("people", n.UNEXPECTED, columns_list="boss", unexpected_list="9"),
            on("nobody", n.UNEXPECTED, columns_list="id", unexpected_list="9"),
        ),
        NOWHERE,
        CTX,
    )
    (row,) = results.summary_by_category(df).collect()
    assert (row.Validation_Category, row.Total_Tables, row.Passed, row.Failed) == (n.CAT_UNEXPECTED, 2, 1, 1)


def test_null_audit_names_its_own_table(spark, people):
    df = plan_run(
        spark,
        config(spark, on("nobody", n.UNIQUE, columns_list="id"), on("people", n.NULL, columns_list="id")),
        NOWHERE,
        CTX,
    )
    got = {(r.VLDTN_CHCK_TYP, r.TBL_NM) for r in results.audit_history(df).collect()}
    assert got == {(n.UNIQUE, "nobody"), (n.NULL, "people")}


def test_empty_table(spark, people):
    got = {r.check_type: r.status for r in run(
        spark,
        on("nobody", n.ROW_COUNT),
        on("nobody", n.NULL, columns_list="id"),
        on("nobody", n.UNIQUE, columns_list="id"),
    )}
    assert got == {n.ROW_COUNT: "Fail", n.NULL: "Pass", n.UNIQUE: "Pass"}


# ---- comparisons -----------------------------------------------------------


def state_of(spark, *entries):
    rows = [("P", stage, n.PRE_POST, layer, key, value, AS_OF) for stage, layer, key, value in entries]
    return spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g timestamp").select(
        *[F.col(x).cast(p.split(" ")[1]).alias(p.split(" ")[0]) for x, p in zip("abcdefg", STATE_SCHEMA.split(", "), strict=True)]
    )


def test_unknown_table_follows_the_first_run_rule(spark, people):
    stage = {"StageName": n.STAGE_PRE_POST, "DestinationLayer": "Bronze"}
    state = state_of(spark, (n.STAGE_PRE_POST, "Silver", "people", "3"), (n.STAGE_PRE_POST, "Bronze", "other", "3"))
    got = {
        r.table_name: (r.previous_result, r.status)
        for r in run(spark, on("people", n.PRE_POST, **stage), on("nobody", n.PRE_POST, **stage), state=state)
    }
    assert got == {"people": (None, "Pass"), "nobody": (None, "Fail")}


def test_previous_and_current_results_keep_their_places(spark, people):
    stage = {"StageName": n.STAGE_PRE_POST, "DestinationLayer": "Bronze"}
    state = state_of(spark, (n.STAGE_PRE_POST, "Bronze", "people", "2"), (n.STAGE_PRE_POST, "Bronze", "nobody", "0"))
    df = plan_run(
        spark, config(spark, on("people", n.PRE_POST, **stage), on("nobody", n.PRE_POST, **stage)), NOWHERE, CTX, state
    )
    got = {r.TBL_NM: (r.PRE_RUN_RSLT, r.POST_RUN_RSLT, r.VLDTN_RSLT) for r in results.audit_history(df).collect()}
    assert got == {"people": (2, 3, "Fail"), "nobody": (0, 0, "Fail")}


def kpi(uid, query, check=n.PRE_POST, **more):
    return on(
        "people", check, StageName=n.STAGE_KPI, UniqueID=uid, DestinationQuery=query, DestinationLayer="Gold",
        AggregateFunction="SUM", columns_list="x", **more,
    )


def test_stored_decimals_are_kept_and_truncated_only_for_the_rule(spark, people):
    state = state_of(spark, (n.STAGE_KPI, "Gold", "u", "100.900000"))
    (row,) = run(spark, kpi("u", "SELECT 120.9"), state=state)
    assert (float(row.previous_result), float(row.current_result)) == (100.9, 120.9)
    assert (row.pct_change, row.status) == (19, "Pass")


@pytest.mark.parametrize(
    ("stored", "query", "pct", "status"),
    [
        ("10", "SELECT 12.9", 29, "Fail"),
        ("0.9", "SELECT 0.1", -88, "Fail"),
        ("0.0000004", "SELECT 0.0000004", 0, "Pass"),
        ("1", "SELECT DATE'2024-01-01'", None, "Error"),
    ],
)
def test_kpis_of_two_runs_are_compared_with_their_decimals(spark, people, stored, query, pct, status):
    (row,) = run(spark, kpi("u", query), state=state_of(spark, (n.STAGE_KPI, "Gold", "u", stored)))
    assert (row.pct_change, row.status) == (pct, status)


def test_a_kpi_that_is_no_number_is_kept_as_text(spark, people):
    (row,) = run(spark, kpi("u", "SELECT DATE'2024-01-01'", check=n.KPI_RESULT))
    assert (row.current_result, row.result_text, row.error) == (None, "2024-01-01", None)


def test_a_missing_kpi_value_fails_the_comparison(spark, people):
    got = run(
        spark,
        kpi("u", "SELECT max(id) FROM nobody"),
        kpi("v", "SELECT max(id) FROM nobody", n.KPI_RESULT),
        kpi("w", "SELECT 5", n.SOURCE_DESTINATION, SourceLocationType=n.LOCATION_CATALOG,
            SourceTableName="s", SourceQuery="SELECT max(id) FROM nobody"),
    )
    by_id = {r.unique_id: (r.current_result, r.status) for r in got}
    assert by_id["u"] == (None, "Fail") and by_id["v"] == (None, None) and by_id["w"][1] == "Fail"
    detail = results.detail(plan_run(spark, config(spark, kpi("v", "SELECT max(id) FROM nobody", n.KPI_RESULT)), NOWHERE, CTX), n.CAT_KPI_RESULT)
    assert detail.first()["KPI_Result"] is None


def test_every_pair_of_location_types(spark, people, tmp_path):
    warehouse = Warehouse("jdbc:derby:memory:pairs;create=true", "org.apache.derby.jdbc.EmbeddedDriver")
    spark.range(4).write.parquet(str(tmp_path / "t"))
    spark.range(4).createOrReplaceTempView("four")
    (spark.range(4).write.format("jdbc").options(**warehouse.all_options()).option("dbtable", "FOUR").mode("overwrite").save())
    places = Locations(layers={"Gold": LayerStore(str(tmp_path))}, warehouse=warehouse)
    query = {
        n.LOCATION_PATH: None,
        n.LOCATION_CATALOG: "SELECT sum(id) FROM four",
        n.LOCATION_WAREHOUSE: 'SELECT SUM("id") AS S FROM FOUR',
    }
    entries = [
        {
            "StageName": n.STAGE_KPI, "ValidationCheck": n.SOURCE_DESTINATION, "UniqueID": f"{s}/{d}",
            "SourceLocationType": s, "DestinationLocationType": d, "SourceLayer": "Gold", "DestinationLayer": "Gold",
            "SourceTableName": "s", "DestinationTableName": "d", "SourceTableLocation": "/t",
            "DestinationTableLocation": "/t", "columns_list": "id", "AggregateFunction": "sum",
            "SourceQuery": query[s], "DestinationQuery": query[d],
        }
        for s in query for d in query
    ]
    got = run(spark, *entries, locations=places)
    assert len(got) == 9
    assert {(float(r.previous_result), float(r.current_result), r.status) for r in got} == {(6.0, 6.0, "Pass")}


def test_row_count_pairs_use_each_sides_location_type(spark, people, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    places = Locations(layers={"Bronze": LayerStore(str(tmp_path))})
    (row,) = run(
        spark,
        on("people", n.SOURCE_DESTINATION, SourceTableName="p", SourceTableLocation="/p", SourceLocationType=n.LOCATION_PATH),
        locations=places,
    )
    assert (int(row.previous_result), int(row.current_result), row.status) == (3, 3, "Pass")


def test_unknown_location_type_raises(spark):
    with pytest.raises(ValueError, match="unknown location type"):
        load_table(spark, "FTP", "x", NOWHERE)
    with pytest.raises(ValueError, match="warehouse"):
        load_table(spark, n.LOCATION_WAREHOUSE, "x", NOWHERE)


def test_a_large_warehouse_table_is_read_by_several_tasks(spark, monkeypatch):
    import dqgate.sources.locations as module

    asked = []
    monkeypatch.setattr(module, "read_warehouse", lambda *a: asked.append(a[2:]))
    places = Locations(warehouse=Warehouse("jdbc:none"), warehouse_partitions={"BIG": ("ID", 8)})
    load_table(spark, n.LOCATION_WAREHOUSE, "BIG", places)
    load_table(spark, n.LOCATION_WAREHOUSE, "SMALL", places)
    assert asked == [("BIG", "ID", 8), ("SMALL", None, 1)]


def test_paths_of_layers_and_registered_tables():
    places = Locations(
        layers={"Bronze": abfss_store("raw", "acct"), "Silver": LayerStore("/silver")},
        registry={"CUST": RegisteredTable(("ID",), {"bronze": "/b/cust", "silver": "/s/cust"})},
        patterns={"Silver": "/{parent}/{sub_area}/{TABLE}"},
    )
    assert places.path("/x", "bronze") == "abfss://raw@acct.dfs.core.windows.net/x"
    assert places.path("s3://b/x", "Bronze") == "s3://b/x"
    assert places.registered_path("CUST", "Silver") == "/silver/s/cust"
    assert places.area_path("cust", "Bronze") == "abfss://raw@acct.dfs.core.windows.net/b/cust"
    assert places.area_path("cust", "silver", parent="Core", sub_area="sales") == "/silver/Core/sales/CUST"
    assert places.area_path("cust", "silver", parent="Derived") == "/silver/Derived/CUST"
    with pytest.raises(ValueError, match="not registered"):
        places.registered_path("CUST", "Gold")


# ---- times, gate, plan shape -----------------------------------------------


def test_all_times_come_from_the_run(spark, people):
    got = run(spark, on("people", n.ROW_COUNT), on("people", n.NULL, columns_list="id"))
    assert {r.created_at for r in got} == {AS_OF}


def test_gate_blocks_on_flagged_failures_and_errors_only(spark, people):
    def gate(*entries):
        return results.stage_gate(plan_run(spark, config(spark, *entries), NOWHERE, CTX)).first()

    bad = {"columns_list": "id", "IsStageDependency": "1"}
    assert gate(on("people", n.NULL, **bad)).blocked
    assert gate(on("missing_view", n.NULL, **bad)).blocked
    assert not gate(on("people", n.NULL, **{**bad, "IsStageDependency": "0"})).blocked
    passed = gate(on("nobody", n.NULL, **bad))
    assert (passed.blocked, passed.blocking_checks, passed.reasons) == (False, 0, "")


def test_each_table_is_scanned_once_for_its_fused_checks(spark, tmp_path):
    spark.range(10).select("id", F.col("id").alias("a"), F.col("id").alias("unused")).write.parquet(str(tmp_path / "t"))
    places = Locations(layers={"Bronze": LayerStore(str(tmp_path))})
    path = {"DestinationLocationType": n.LOCATION_PATH, "DestinationTableLocation": "/t", "RowCountTableLocation": "/t"}
    df = plan_run(
        spark,
        config(
            spark,
            on("t", n.ROW_COUNT, **path),
            on("t", n.NULL, columns_list="id,a", **path),
            on("t", n.UNEXPECTED, columns_list="id", unexpected_list="3", **path),
        ),
        places,
        CTX,
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "unused" not in plan
    assert {r.unexpected_rows for r in df.collect()} == {None, 0, 1}


def test_a_large_configuration_is_read_whole(spark):
    one = config(spark, on("people", n.NULL, columns_list="a"))
    many = one.crossJoin(spark.range(25_000)).withColumn("columns_list", F.concat(F.lit("c"), "id")).drop("id")
    items = collect_items(many)
    assert len({i.columns[0] for i in items}) == len(items) == 25_000


def test_a_row_count_with_an_id_is_compared_with_its_previous_run(spark, people):
    from dqgate.sinks.state import state_of as stored_state

    entry = on("people", n.PRE_POST, StageName=n.STAGE_PRE_POST, DestinationLayer="Bronze", UniqueID="U")
    first = plan_run(spark, config(spark, entry), NOWHERE, CTX)
    (row,) = run(spark, entry, state=stored_state(first))
    assert (row.previous_result, row.current_result, row.status) == (3, 3, "Pass")


def test_an_unreadable_flag_is_an_error_and_blocks(spark, people):
    df = plan_run(spark, config(spark, on("people", n.ROW_COUNT, IsStageDependency="perhaps")), NOWHERE, CTX)
    assert [(r.status, "perhaps" in r.error) for r in df.collect()] == [("Error", True)]
    assert results.stage_gate(df).first().blocked
    (row,) = run(spark, on("people", n.ROW_COUNT, IsStageDependency="Yes"))
    assert row.on_stage_depend == 1


def test_a_stage_that_cannot_be_recorded_blocks_and_the_others_run(spark, people, tmp_path, monkeypatch):
    real, calls = batch.append_history, []

    def breaks_once(audit, *more):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("disk full")
        real(audit, *more)

    monkeypatch.setattr(batch, "append_history", breaks_once)
    cfg = config(spark, on("people", n.ROW_COUNT), on("people", n.ROW_COUNT, StageName=n.STAGE_SILVER))
    output = Output(str(tmp_path / "out"))
    for blocked in ({n.STAGE_BRONZE: True, n.STAGE_SILVER: False}, {n.STAGE_BRONZE: False, n.STAGE_SILVER: False}):
        gate = {r.stage: r.blocked for r in run_and_save(spark, cfg, NOWHERE, CTX, output).collect()}
        assert gate == blocked
    # The second run has the id of the first: each stage stands in the history once.
    assert read_history(spark, output.history).count() == 2


# ---- batches ---------------------------------------------------------------


def test_run_and_save_keeps_everything(spark, sf_dir, tmp_path):
    demo.register(spark, sf_dir)
    output = Output(str(tmp_path / "out"))
    cfg, places = demo.config(spark), demo.locations(sf_dir)
    day1 = RunContext(as_of=AS_OF, run_id="one")
    day2 = RunContext(as_of=AS_OF + dt.timedelta(days=1), run_id="two")
    gate = {r.stage: r.blocked for r in run_and_save(spark, cfg, places, day1, output).collect()}
    assert gate == {
        n.STAGE_BRONZE: True, n.STAGE_SILVER: False, n.STAGE_GOLD: True, n.STAGE_PRE_POST: False, n.STAGE_KPI: False,
    }
    folder = output.stage(demo.PIPELINE, n.STAGE_PRE_POST)
    first = spark.read.parquet(f"{folder}/{n.CAT_PRE_POST}")
    assert {r["Previous_Row_Count"] for r in first.collect()} == {"0"}
    assert read_state(spark, output.state).count() == 6 + 3
    run_and_save(spark, cfg, places, day2, output).collect()
    second = {r["Table_Name"]: r for r in spark.read.parquet(f"{folder}/{n.CAT_PRE_POST}").collect()}
    assert second["orders"]["Previous_Row_Count"] == "1,500"
    assert read_state(spark, output.state).count() == 9
    history = read_history(spark, output.history)
    assert history.count() == 88 and history.select("CRTD_TM").distinct().count() == 2
    summary = spark.read.parquet(f"{output.stage(demo.PIPELINE, n.STAGE_BRONZE)}/Summary Table")
    assert summary.columns == ["Validation_Category", "Total_Tables", "Passed", "Failed"]
    kinds = spark.read.parquet(f"{output.stage(demo.PIPELINE, n.STAGE_KPI)}/Summary Table")
    assert kinds.count() == 3


def test_a_table_that_breaks_while_it_is_read_loses_only_its_own_checks(spark, people, tmp_path):
    spark.sql("SELECT raise_error('broken file') AS id").createOrReplaceTempView("broken")
    cfg = config(
        spark,
        on("broken", n.NULL, columns_list="id", IsStageDependency="1"),
        on("people", n.ROW_COUNT),
        on("people", n.UNIQUE, columns_list="id"),
        on("nobody", n.NULL, columns_list="id", StageName=n.STAGE_SILVER),
    )
    gate = {
        r.stage: (r.blocked, r.blocking_checks)
        for r in run_and_save(spark, cfg, NOWHERE, CTX, Output(str(tmp_path / "out"))).collect()
    }
    assert gate == {n.STAGE_BRONZE: (True, 1), n.STAGE_SILVER: (False, 0)}
    stored = spark.read.parquet(Output(str(tmp_path / "out")).stage("P", n.STAGE_BRONZE) + "/check_result")
    got = {r.check_type: (r.status, "broken file" in (r.error or "")) for r in stored.collect()}
    assert got == {n.NULL: ("Error", True), n.ROW_COUNT: ("Pass", False), n.UNIQUE: ("Pass", False)}


def test_many_tables_are_computed_in_several_jobs(spark, people, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "FRAMES_PER_JOB", 2)
    entries = [on(v, n.NULL, columns_list="id") for v in ("people", "nobody")]
    entries += [on("people", n.UNIQUE, columns_list=c) for c in ("id", "name", "boss")]
    planned = prepare_run(spark, config(spark, *entries), NOWHERE)
    metrics, failed = batch.compute(planned, str(tmp_path / "m"))
    assert failed == {} and len(list((tmp_path / "m").iterdir())) == 3
    assert rows(planned.judge(metrics, CTX)) == rows(plan_run(spark, config(spark, *entries), NOWHERE, CTX))


def test_a_stage_that_cannot_be_planned_is_recorded(spark, people, tmp_path, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("no state")

    monkeypatch.setattr(batch, "read_state", broken)
    cfg = config(spark, on("people", n.ROW_COUNT, IsStageDependency="1"))
    (gate,) = run_and_save(spark, cfg, NOWHERE, CTX, Output(str(tmp_path / "out"))).collect()
    assert (gate.stage, gate.blocked) == (n.STAGE_BRONZE, True)


def test_one_stage_of_a_pipeline_with_its_audit_in_a_warehouse(spark, people, tmp_path):
    warehouse = Warehouse("jdbc:derby:memory:audit;create=true", "org.apache.derby.jdbc.EmbeddedDriver")
    output = Output(str(tmp_path / "out"), warehouse, "AUDIT_OF_RUNS")
    cfg = config(
        spark,
        on("people", n.NULL, columns_list="id,name"),
        on("people", n.ROW_COUNT, StageName=n.STAGE_SILVER),
    )
    gate = run_and_save(spark, cfg, NOWHERE, CTX, output, "P", n.STAGE_BRONZE).collect()
    assert [r.stage for r in gate] == [n.STAGE_BRONZE]
    stored = read_history_table(spark, warehouse, "AUDIT_OF_RUNS")
    assert rows(stored) == rows(read_history(spark, output.history)) and stored.count() == 2
    with pytest.raises(ValueError, match="no active checks"):
        run_and_save(spark, cfg, NOWHERE, CTX, output, "P", n.STAGE_GOLD)

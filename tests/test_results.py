from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.plans import results
from dqgate.plans.run import RunContext, plan_run
from dqgate.schemas import AUDIT_SCHEMA
from tests.test_config import config
from tests.test_run import NOWHERE, on, view


def test_text_null_becomes_null_and_numbers_are_truncated(spark):
    loose = {
        "JOB_ID": "1", "ROW_CNT": "NULL", "SRC_RSLT": "null", "DEST_RSLT": "-12.9", "KPI_RSLT": "3758439620.06",
        "TBL_NM": "t", "SRC_LAYR": "NULL", "CRTD_TM": "2024-01-31 06:00:00", "ON_STG_DPND": "0",
    }
    df = spark.createDataFrame(
        [tuple(loose.get(c) for c in AUDIT_SCHEMA.names)], ", ".join(f"{c} string" for c in AUDIT_SCHEMA.names)
    )
    got = results.audit_typed(df)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in AUDIT_SCHEMA]
    row = got.first()
    assert (row.ROW_CNT, row.SRC_RSLT, row.DEST_RSLT, row.KPI_RSLT) == (None, None, -12, 3758439620)
    assert (row.SRC_LAYR, row.TBL_NM, row.CRTD_TM) == (None, "t", dt.datetime(2024, 1, 31, 6))


def test_overlay_is_one_join_however_many_checks(spark):
    audit = spark.createDataFrame([("t1", "NullCheck"), ("t2", "NullCheck"), (None, "X")], "TBL_NM string, VLDTN_CHCK_TYP string")
    cfg = config(
        spark,
        *[on(f"t{i}", n.NULL, IsStageDependency="1") for i in range(2, 60)],
        on("t1", n.UNIQUE, IsStageDependency="1"),
        on("t2", n.NULL, IsStageDependency="no"),
    )
    got = results.stage_dep_overlay(audit.withColumn("ON_STG_DPND", F.lit(9)), cfg)
    assert {r.TBL_NM: r.ON_STG_DPND for r in got.collect()} == {"t1": 0, "t2": 1, None: 0}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_report_numbers_rows_and_names_columns(spark):
    view(spark, "zeta", [(1,)], "id int")
    view(spark, "alpha", [(None,)], "id int")
    df = plan_run(
        spark,
        config(spark, on("zeta", n.NULL, columns_list="id"), on("alpha", n.NULL, columns_list="id")),
        NOWHERE,
        RunContext(as_of=dt.datetime(2024, 1, 31, 6)),
    )
    report = results.report_rows(df, n.CAT_NULL)
    assert report.columns == ["#", "Pipeline", "Stage", "Tables Name", "Validated On", "Column Name", "Validation Result"]
    assert [(r[0], r[3]) for r in report.orderBy("#").collect()] == [(1, "alpha"), (2, "zeta")]


def test_summary_adds_up(spark):
    for i in range(4):
        view(spark, f"tab{i}", [(i if i % 2 else None,)], "id int")
    df = plan_run(
        spark,
        config(
            spark,
            *[on(f"tab{i}", n.NULL, columns_list="id") for i in range(4)],
            *[on(f"tab{i}", n.ROW_COUNT) for i in range(4)],
            on("gone", n.NULL, columns_list="id"),
        ),
        NOWHERE,
        RunContext(as_of=dt.datetime(2024, 1, 31, 6)),
    )
    got = {r.Validation_Category: (r.Total_Tables, r.Passed, r.Failed) for r in results.summary_by_category(df).collect()}
    assert got == {n.CAT_NULL: (5, 2, 3), n.CAT_ROW_COUNT: (4, 4, 0)}
    assert all(total == passed + failed for total, passed, failed in got.values())
    assert results.error_rows(df).count() == 1

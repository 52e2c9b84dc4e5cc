"""Configured runs and what is derived from their results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.functions.formatting import session_time
from dqgate.plans import results
from dqgate.plans.batch import Output, run_and_save
from dqgate.plans.run import RunContext, plan_run
from dqgate.schemas import CONFIG_COLUMNS
from dqgate.session import scratch_dir
from dqgate.sinks import history as history_store
from dqgate.sinks.layers import overwrite
from dqgate.sinks import state as state_store
from dqgate.sources.locations import Locations
from workload import demo
from workload.expected import over_result, shown_count, shown_number
from workload.registry import plain, query

_ON = "'01-31-2024 06:00' AS \"Validated_On\""


def _without_folder(df):
    """KPI queries on a path name its folder, which differs from place to place."""
    for column in df.columns:
        if column.endswith("Query"):
            df = df.withColumn(column, F.regexp_replace(column, "`.*/", "`"))
    return df


def _detail(name: str, category: str, checks: list[str], stages: list[str], sql_columns: str) -> None:
    sql = over_result(f"SELECT {sql_columns} FROM check_result WHERE category = '{category}'")

    @query(name, sql)
    def run(spark, sf_dir):
        return _without_folder(results.detail(demo.result(spark, sf_dir, checks, stages), category))


_LAYERED = [n.STAGE_BRONZE, n.STAGE_SILVER, n.STAGE_GOLD]
_QUALITY = f'table_name AS "Tables_Name", {_ON}, column_name AS "Column_Name", status AS "Validation_Result"'

_detail(
    "detail_row_count", n.CAT_ROW_COUNT, [n.ROW_COUNT], _LAYERED,
    f'table_name AS "Table_Name", {_ON}, {shown_count("current_result")} AS "Row_Count", '
    'status AS "Validation_Result"',
)
_detail(
    "detail_src_dest", n.CAT_SOURCE_DESTINATION, [n.SOURCE_DESTINATION], _LAYERED,
    f'src_table AS "Source_Table_Name", dest_table AS "Destination_Table_Name", {_ON}, '
    f'{shown_count("previous_result")} AS "Source_Row_Count", '
    f'{shown_count("current_result")} AS "Destination_Row_Count", status AS "Validation_Result"',
)
_detail("detail_null", n.CAT_NULL, [n.NULL], _LAYERED, _QUALITY)
_detail("detail_duplicates", n.CAT_UNIQUE, [n.UNIQUE], _LAYERED, _QUALITY)
_detail("detail_sla", n.CAT_SLA, [n.SLA], _LAYERED, _QUALITY)
_detail(
    "detail_unexpected", n.CAT_UNEXPECTED, [n.UNEXPECTED], _LAYERED,
    f'table_name AS "Tables_Name", {_ON}, column_name AS "Column_Name", '
    'unexpected_value AS "Unexpected_Value", status AS "Validation_Result"',
)
_detail(
    "detail_foreign_key", n.CAT_FOREIGN_KEY, [n.FOREIGN_KEY], _LAYERED,
    f'table_name AS "Tables_Name", dest_table AS "Dimension_Table_Name", {_ON}, '
    'column_name AS "Column_Name", status AS "Validation_Result"',
)
_detail(
    "detail_pre_post", n.CAT_PRE_POST, [n.PRE_POST], [n.STAGE_PRE_POST],
    f'layer AS "Layer", table_name AS "Table_Name", {_ON}, '
    f'{shown_count("previous_result")} AS "Previous_Row_Count", '
    f'{shown_count("current_result")} AS "Current_Row_count", status AS "Validation_Result"',
)
_detail(
    "detail_kpi_pre_post", n.CAT_KPI_PRE_POST, [n.PRE_POST], [n.STAGE_KPI],
    'kpi_name AS "KPI_Name", table_name AS "Table_Name", layer AS "Layer", dest_query AS "Query", '
    f'agg_function AS "Aggregate_Function", {_ON}, '
    f'coalesce({shown_number("previous_result")}, \'0\') AS "Previous_Result", '
    f'{shown_number("current_result")} AS "Current_Result", status AS "Validation_Result"',
)
_detail(
    "detail_kpi_src_dest", n.CAT_KPI_SOURCE_DESTINATION, [n.SOURCE_DESTINATION], [n.STAGE_KPI],
    'kpi_name AS "KPI_Name", src_table AS "Source_Table_Name", dest_table AS "Destination_Table_Name", '
    'src_layer AS "Source_Layer", layer AS "Destination_Layer", src_query AS "Source_Query", '
    f'dest_query AS "Destination_Query", agg_function AS "Aggregate_Function", {_ON}, '
    f'{shown_number("previous_result")} AS "Source_Result", '
    f'{shown_number("current_result")} AS "Destination_Result", status AS "Validation_Result"',
)
_detail(
    "detail_kpi_result", n.CAT_KPI_RESULT, [n.KPI_RESULT], [n.STAGE_KPI],
    'kpi_name AS "KPI_Name", table_name AS "Table_Name", dest_query AS "Query", '
    f'agg_function AS "Aggregate_Function", {_ON}, {shown_number("current_result")} AS "KPI_Result"',
)


# ---- comparisons as configured checks --------------------------------------

_COMPARED = "previous_result, current_result, pct_change, status"
_COMPARED_SQL = (
    "CAST(previous_result AS DOUBLE) AS previous_result, "
    "CAST(current_result AS DOUBLE) AS current_result, pct_change, status"
)


@query(
    "pre_post_rowcount",
    over_result(
        f"SELECT layer, table_name, {_COMPARED_SQL} FROM check_result WHERE category = 'Pre Post Runs'"
    ),
)
def pre_post_rowcount(spark, sf_dir):
    result = demo.result(spark, sf_dir, [n.PRE_POST], [n.STAGE_PRE_POST])
    return plain(result.select("layer", "table_name", *_COMPARED.split(", ")))


@query(
    "kpi_pre_post",
    over_result(
        f"SELECT unique_id, kpi_name, {_COMPARED_SQL} FROM check_result WHERE category = 'Pre-Post Run'"
    ),
)
def kpi_pre_post(spark, sf_dir):
    result = demo.result(spark, sf_dir, [n.PRE_POST], [n.STAGE_KPI])
    return plain(result.select("unique_id", "kpi_name", *_COMPARED.split(", ")))


@query(
    "kpi_src_dest",
    over_result(
        "SELECT unique_id, src_table, dest_table, "
        f"{_COMPARED_SQL} FROM check_result WHERE category = 'Source Destination'"
    ),
)
def kpi_src_dest(spark, sf_dir):
    result = demo.result(spark, sf_dir, [n.SOURCE_DESTINATION], [n.STAGE_KPI])
    return plain(result.select("unique_id", "src_table", "dest_table", *_COMPARED.split(", ")))


@query(
    "kpi_result",
    over_result(
        "SELECT unique_id, kpi_name, table_name, CAST(current_result AS DOUBLE) AS current_result, status "
        "FROM check_result "
        "WHERE category = 'KPI'"
    ),
)
def kpi_result(spark, sf_dir):
    result = demo.result(spark, sf_dir, [n.KPI_RESULT], [n.STAGE_KPI])
    return plain(result.select("unique_id", "kpi_name", "table_name", "current_result", "status"))


# ---- summaries -------------------------------------------------------------

_PER_TABLE = (
    "SELECT {groups}, concat(coalesce(src_table, ''), '->', coalesce(table_name, dest_table)) AS t, "
    "bool_and(coalesce(status = 'Pass', false)) AS passed FROM check_result WHERE {where} "
    "GROUP BY {groups}, t"
)
_TALLIES = (
    'count(*) AS "Total_Tables", count(*) FILTER (WHERE passed) AS "Passed", '
    'count(*) FILTER (WHERE NOT passed) AS "Failed"'
)
_BY_CATEGORY = (
    f'SELECT pipeline, stage, category AS "Validation_Category", {_TALLIES} FROM ('
    + _PER_TABLE.format(
        groups="pipeline, stage, category", where="family IN ('row_count', 'data_quality')"
    )
    + ") GROUP BY pipeline, stage, category"
)
_BY_LAYER = (
    'SELECT pipeline, layer AS "Layer", lower(layer) || \'-container\' AS "Container", '
    f"lower(layer) || '-account' AS \"Storage_Account\", {_TALLIES} FROM ("
    + _PER_TABLE.format(groups="pipeline, layer", where="category = 'Pre Post Runs'")
    + ") GROUP BY pipeline, layer"
)
_KPI_KINDS = "SELECT DISTINCT pipeline, category AS \"Validation_Checks\" FROM check_result WHERE family = 'kpi'"


@query("summary_by_category", over_result(_BY_CATEGORY))
def summary_by_category(spark, sf_dir):
    return results.summary_by_category(demo.result(spark, sf_dir, stages=_LAYERED))


@query("summary_by_layer", over_result(_BY_LAYER))
def summary_by_layer(spark, sf_dir):
    result = demo.result(spark, sf_dir, stages=[n.STAGE_PRE_POST])
    return results.summary_by_layer(result, demo.locations(sf_dir).layers)


@query("kpi_summary", over_result(_KPI_KINDS))
def kpi_summary(spark, sf_dir):
    return results.kpi_summary(demo.result(spark, sf_dir, stages=[n.STAGE_KPI]))


@query(
    "summary_all",
    over_result(
        f'SELECT pipeline, stage, "Validation_Category" AS "Scope", "Total_Tables", "Passed", "Failed" '
        f"FROM ({_BY_CATEGORY}) UNION ALL "
        f"SELECT pipeline, '{n.STAGE_PRE_POST}', \"Layer\", \"Total_Tables\", \"Passed\", \"Failed\" "
        f"FROM ({_BY_LAYER}) UNION ALL "
        f"SELECT pipeline, '{n.STAGE_KPI}', \"Validation_Checks\", NULL, NULL, NULL FROM ({_KPI_KINDS})"
    ),
)
def summary_all(spark, sf_dir):
    # Written once: every summary below reads the stored result, not the tables.
    stored = scratch_dir(spark, "summary")
    overwrite(demo.result(spark, sf_dir), stored)
    return results.summary_all(spark.read.parquet(stored), demo.locations(sf_dir).layers)


# ---- audit history ---------------------------------------------------------

_BIG = "CAST(CASE WHEN {when} THEN trunc({value}) END AS BIGINT)"
_PAIRS = "category IN ('Source Destination Row Count', 'Source Destination')"
_RERUNS = "category IN ('Pre Post Runs', 'Pre-Post Run')"
_CREATED = "TIMESTAMP '2024-01-31 06:00:00'"
_AUDIT = f"""
SELECT CAST(7 AS BIGINT) AS "JOB_ID", CAST(11 AS BIGINT) AS "TSK_ID", pipeline AS "PPLN_NM",
       stage AS "STG_NM", check_type AS "VLDTN_CHCK_TYP",
       CASE WHEN category = 'Source Destination' THEN src_layer END AS "SRC_LAYR",
       CASE WHEN category = 'Source Destination' OR {_RERUNS} THEN layer END AS "DEST_LAYR",
       table_name AS "TBL_NM", agg_function AS "AGGR_FNCTN",
       {_BIG.format(when="category = 'Row Count'", value='current_result')} AS "ROW_CNT",
       src_table AS "SRC_TBL_NM", dest_table AS "DEST_TBL_NM",
       {_BIG.format(when=_PAIRS, value='previous_result')} AS "SRC_RSLT",
       {_BIG.format(when=_PAIRS, value='current_result')} AS "DEST_RSLT",
       CASE WHEN family = 'data_quality' THEN column_name END AS "COL_NM",
       unexpected_value AS "UNXPCTD_VAL",
       {_BIG.format(when="category = 'KPI'", value='current_result')} AS "KPI_RSLT",
       {_BIG.format(when=_RERUNS, value='current_result')} AS "POST_RUN_RSLT",
       {_BIG.format(when=_RERUNS, value='previous_result')} AS "PRE_RUN_RSLT",
       status AS "VLDTN_RSLT", 'demo' AS "CRTD_BY", {_CREATED} AS "CRTD_TM",
       on_stage_depend AS "ON_STG_DPND"
FROM check_result"""


@query("audit_history", over_result(_AUDIT))
def audit_history(spark, sf_dir):
    return results.audit_history(demo.result(spark, sf_dir))


# History of many runs: one record per event, created at its time.
_HISTORY = """
SELECT event_id AS "JOB_ID", user_id AS "TSK_ID",
       concat('PL_', event_type) AS "PPLN_NM", 'Bronze data check' AS "STG_NM",
       'RowCount' AS "VLDTN_CHCK_TYP", CAST(NULL AS {text}) AS "SRC_LAYR",
       CAST(NULL AS {text}) AS "DEST_LAYR",
       concat('T', CAST(user_id AS {text})) AS "TBL_NM", CAST(NULL AS {text}) AS "AGGR_FNCTN",
       event_id * 3 AS "ROW_CNT", CAST(NULL AS {text}) AS "SRC_TBL_NM",
       CAST(NULL AS {text}) AS "DEST_TBL_NM", CAST(NULL AS BIGINT) AS "SRC_RSLT",
       CAST(NULL AS BIGINT) AS "DEST_RSLT", CAST(NULL AS {text}) AS "COL_NM",
       CAST(NULL AS {text}) AS "UNXPCTD_VAL", CAST(NULL AS BIGINT) AS "KPI_RSLT",
       CAST(NULL AS BIGINT) AS "POST_RUN_RSLT", CAST(NULL AS BIGINT) AS "PRE_RUN_RSLT",
       CASE WHEN event_type = 'error' THEN 'Fail' ELSE 'Pass' END AS "VLDTN_RSLT",
       'demo' AS "CRTD_BY", CAST(ts AS TIMESTAMP) AS "CRTD_TM",
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS "ON_STG_DPND"
FROM events"""
_HISTORY_SQL = _HISTORY.format(text="VARCHAR")


def event_history(spark, sf_dir):
    demo.register(spark, sf_dir)
    return spark.sql(_HISTORY.format(text="STRING").replace('"', "`"))


@query(
    "history_retention",
    f'SELECT * FROM ({_HISTORY_SQL}) WHERE "CRTD_TM" >= TIMESTAMP \'2024-02-20 12:00:00\' - INTERVAL 35 DAY',
)
def history_retention(spark, sf_dir):
    return history_store.retained(event_history(spark, sf_dir), dt.datetime(2024, 2, 20, 12))


# Audit rows that mix text into numeric columns, as older writers left them.
_LOOSE = """
SELECT JOB_ID, TSK_ID, PPLN_NM, STG_NM, VLDTN_CHCK_TYP, 'NULL' AS SRC_LAYR, 'null' AS DEST_LAYR, TBL_NM,
       AGGR_FNCTN, CASE WHEN VLDTN_RSLT = 'Fail' THEN 'NULL' ELSE concat(CAST(ROW_CNT AS STRING), '.75') END AS ROW_CNT,
       SRC_TBL_NM, DEST_TBL_NM, 'NULL' AS SRC_RSLT, CAST(-ROW_CNT AS STRING) AS DEST_RSLT, COL_NM,
       UNXPCTD_VAL, 'n/a' AS KPI_RSLT, POST_RUN_RSLT, PRE_RUN_RSLT, VLDTN_RSLT, CRTD_BY, CRTD_TM, ON_STG_DPND
FROM event_history"""


@query(
    "audit_typed",
    'SELECT * REPLACE (CASE WHEN "VLDTN_RSLT" = \'Fail\' THEN NULL ELSE "ROW_CNT" END AS "ROW_CNT", '
    f'-"ROW_CNT" AS "DEST_RSLT") FROM ({_HISTORY_SQL})',
)
def audit_typed(spark, sf_dir):
    event_history(spark, sf_dir).createOrReplaceTempView("event_history")
    return results.audit_typed(spark.sql(_LOOSE))


@query("append_history", _HISTORY_SQL)
def append_history(spark, sf_dir):
    """Two appends; the second must leave what the first wrote."""
    rows = event_history(spark, sf_dir)
    location = scratch_dir(spark, "history")
    history_store.append_history(rows.where("VLDTN_RSLT = 'Pass'"), location)
    history_store.append_history(rows.where("VLDTN_RSLT <> 'Pass'"), location)
    return history_store.read_history(spark, location)


@query("history_compacted", _HISTORY_SQL)
def history_compacted(spark, sf_dir):
    """Runs of which one is repeated after its days were packed: each row is there once."""
    rows = event_history(spark, sf_dir)
    location = scratch_dir(spark, "history")
    for run in range(3):
        history_store.append_history(rows.where(F.col("JOB_ID") % 3 == run), location, f"run {run}")
    history_store.compact_history(spark, location, least_writes=2)
    history_store.append_history(rows.where("JOB_ID % 3 = 1"), location, "run 1")
    return history_store.read_history(spark, location)


@query(
    "history_purge",
    f"SELECT * FROM ({_HISTORY_SQL}) WHERE \"CRTD_TM\" >= TIMESTAMP '2024-02-20 12:00:00' - INTERVAL 35 DAY",
)
def history_purge(spark, sf_dir):
    """Expired days leave storage; the day of the limit is rewritten."""
    location = scratch_dir(spark, "history")
    history_store.append_history(event_history(spark, sf_dir), location)
    history_store.purge_history(spark, location, dt.datetime(2024, 2, 20, 12))
    return history_store.read_history(spark, location)


@query("read_history", over_result(_AUDIT))
def read_history(spark, sf_dir):
    location = scratch_dir(spark, "history")
    history_store.append_history(results.audit_history(demo.result(spark, sf_dir)), location)
    return history_store.read_history(spark, location)


# ---- stage dependency, gate, report ----------------------------------------


@query(
    "stage_dep_overlay",
    'SELECT h.* REPLACE (CASE WHEN c.c_custkey IS NULL THEN 0 ELSE 1 END AS "ON_STG_DPND") '
    f"FROM ({_HISTORY_SQL}) h LEFT JOIN customer c "
    "ON h.\"TSK_ID\" = c.c_custkey AND c.c_mktsegment = 'BUILDING'",
)
def stage_dep_overlay(spark, sf_dir):
    """Every customer is a table with a configured row count; those of one segment are flagged."""
    given = {
        "StageName": F.lit(n.STAGE_BRONZE),
        "Check_Status": F.lit("yes"),
        "RowCountTableName": F.concat(F.lit("T"), "c_custkey"),
        "ValidationCheck": F.lit(n.ROW_COUNT),
        "IsStageDependency": F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no"),
    }
    configured = demo.table(spark, sf_dir, "customer").select(
        *[given.get(c, F.lit(None)).cast("string").alias(c) for c in CONFIG_COLUMNS]
    )
    return results.stage_dep_overlay(event_history(spark, sf_dir), configured)


@query(
    "stage_gate",
    over_result(
        """SELECT pipeline, stage, bool_or(stops) AS blocked, count(*) FILTER (WHERE stops) AS blocking_checks,
                  coalesce(string_agg(DISTINCT reason, '; ' ORDER BY reason) FILTER (WHERE stops), '') AS reasons
           FROM (SELECT *, coalesce(status IN ('Fail', 'Error') AND on_stage_depend = 1, false) AS stops,
                        concat_ws(' ', category, coalesce(table_name, concat_ws('->', src_table, dest_table)),
                                  column_name) AS reason
                 FROM check_result) GROUP BY pipeline, stage"""
    ),
)
def stage_gate(spark, sf_dir):
    return results.stage_gate(demo.result(spark, sf_dir))


@query(
    "report_rows",
    over_result(
        'SELECT row_number() OVER (PARTITION BY pipeline, stage ORDER BY table_name, column_name, status) AS "#", '
        'pipeline AS "Pipeline", stage AS "Stage", table_name AS "Tables Name", \'01-31-2024 06:00\' AS "Validated On", column_name AS "Column Name", '
        'status AS "Validation Result" FROM check_result WHERE category = \'Null Column Validation\''
    ),
)
def report_rows(spark, sf_dir):
    return results.report_rows(demo.result(spark, sf_dir, [n.NULL], _LAYERED), n.CAT_NULL)


@query(
    "report_summary",
    over_result(
        'SELECT row_number() OVER (PARTITION BY pipeline, stage ORDER BY "Scope") AS "#", pipeline AS "Pipeline", '
        'stage AS "Stage", "Scope", "Total_Tables" AS "Total Tables", "Passed", "Failed" FROM ('
        'SELECT pipeline, stage, "Validation_Category" AS "Scope", "Total_Tables", "Passed", "Failed" '
        f"FROM ({_BY_CATEGORY}) UNION ALL "
        f"SELECT pipeline, '{n.STAGE_PRE_POST}', \"Layer\", \"Total_Tables\", \"Passed\", \"Failed\" "
        f"FROM ({_BY_LAYER}) UNION ALL "
        f"SELECT pipeline, '{n.STAGE_KPI}', \"Validation_Checks\", NULL, NULL, NULL FROM ({_KPI_KINDS}))"
    ),
)
def report_summary(spark, sf_dir):
    stored = scratch_dir(spark, "summary")
    overwrite(demo.result(spark, sf_dir), stored)
    return results.report_summary(spark.read.parquet(stored), demo.locations(sf_dir).layers)


_ALL_COLUMNS = (
    "pipeline, stage, family, category, check_type, layer, src_layer, table_name, src_table, dest_table, "
    "column_name, unexpected_value, unique_id, kpi_name, agg_function, total_rows, unexpected_rows, "
    "unexpected_keys, pct_change, status, on_stage_depend"
)


@query(
    "run_all",
    over_result(
        f"SELECT {_ALL_COLUMNS}, CAST(previous_result AS DOUBLE) AS previous_result, "
        "CAST(CASE WHEN category <> 'SLA Check Validation' THEN current_result END AS DOUBLE) "
        "AS current_result FROM check_result"
    ),
)
def run_all(spark, sf_dir):
    """Every check of every stage in one plan."""
    result = demo.result(spark, sf_dir)
    not_sla = F.coalesce(F.col("category") != n.CAT_SLA, F.lit(True))
    return plain(
        result.select(
            *_ALL_COLUMNS.split(", "),
            "previous_result",
            F.when(not_sla, F.col("current_result")).alias("current_result"),
        )
    )


@query(
    "save_state",
    over_result(
        "SELECT stage, layer, coalesce(unique_id, table_name) AS state_key, CAST(current_result AS DOUBLE) AS result, "
        f"{_CREATED} AS run_ts FROM check_result WHERE category IN ('Pre Post Runs', 'Pre-Post Run') "
        "UNION ALL SELECT 'Pre and post runs rowcount check', 'Bronze', 'retired_table', "
        "CAST((SELECT count(*) FROM supplier) AS DOUBLE), TIMESTAMP '2024-01-30 06:00:00'"
    ),
)
def save_state(spark, sf_dir):
    """Results of this run replace stored ones; a key not in this run survives."""
    location = scratch_dir(spark, "state")
    old = demo.state(spark, sf_dir)
    retired = demo.table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("c")).select(
        F.lit(demo.PIPELINE).alias("pipeline"),
        F.lit(n.STAGE_PRE_POST).alias("stage"),
        F.lit(n.PRE_POST).alias("check_type"),
        F.lit(n.BRONZE).alias("layer"),
        F.lit("retired_table").alias("state_key"),
        F.col("c").cast("decimal(38,12)").alias("result"),
        session_time(demo.PREVIOUS_RUN).alias("run_ts"),
    )
    state_store.save_state(spark, old.unionByName(retired), location)
    result = demo.result(spark, sf_dir, [n.PRE_POST], [n.STAGE_PRE_POST, n.STAGE_KPI])
    state_store.save_state(spark, state_store.state_of(result), location)
    stored = state_store.read_state(spark, location)
    return plain(stored.select("stage", "layer", "state_key", "result", "run_ts"))


# ---- results of repeated runs ----------------------------------------------


def _second_run(spark, entries, first_tables, second_tables):
    """The result of a second run, compared with the state that a first run of the same checks stored."""
    location = scratch_dir(spark, "state")
    cfg, store = demo.config(spark, entries), Locations(layers={})
    for name, df in first_tables.items():
        df.createOrReplaceTempView(name)
    before = RunContext(as_of=demo.PREVIOUS_RUN, run_id="first")
    state_store.save_state(spark, state_store.state_of(plan_run(spark, cfg, store, before)), location)
    for name, df in second_tables.items():
        df.createOrReplaceTempView(name)
    return plan_run(spark, cfg, store, demo.CONTEXT, state_store.read_state(spark, location))


@query(
    "pre_post_second_run",
    """SELECT 'run_orders' AS table_name, CAST(p AS DOUBLE) AS previous_result, CAST(c AS DOUBLE) AS current_result,
              CAST(trunc((c - p) * 100.0 / p) AS BIGINT) AS pct_change, 'Fail' AS status
       FROM (SELECT count(*) AS p, count(*) FILTER (WHERE o_orderkey % 10 = 0) AS c FROM orders)""",
)
def pre_post_second_run(spark, sf_dir):
    """A row count with a `UniqueID` finds its own previous result: a tenth of the rows is left."""
    orders = demo.table(spark, sf_dir, "orders")
    entry = {
        "PipelineName": demo.PIPELINE, "StageName": n.STAGE_PRE_POST, "Check_Status": "yes",
        "ValidationCheck": n.PRE_POST, "UniqueID": "U1", "RowCountTableName": "run_orders",
        "RowCountTableLocation": "run_orders", "DestinationLocationType": n.LOCATION_CATALOG,
        "DestinationLayer": n.BRONZE,
    }
    tables = ({"run_orders": orders}, {"run_orders": orders.where("o_orderkey % 10 = 0")})
    result = _second_run(spark, [entry], *tables)
    return plain(result.select("table_name", "previous_result", "current_result", "pct_change", "status"))


_SHARES = {"S1": "SELECT avg(CASE WHEN o_orderstatus = 'F' THEN 1.0D ELSE 0.0D END) FROM run_orders",
           "S2": "SELECT CAST(count(*) AS DOUBLE) / 1000000000 FROM run_orders"}


def _share_entry(uid: str, query_text: str, check: str = n.PRE_POST) -> dict[str, str]:
    return {
        "PipelineName": demo.PIPELINE, "StageName": n.STAGE_KPI, "Check_Status": "yes", "ValidationCheck": check,
        "UniqueID": uid, "KPIName": uid, "DestinationTableName": "run_orders", "DestinationTableLocation": "run_orders",
        "DestinationLocationType": n.LOCATION_CATALOG, "DestinationLayer": n.GOLD, "DestinationQuery": query_text,
    }


@query(
    "kpi_pre_post_fraction",
    """WITH k AS (
         SELECT 'S1' AS unique_id, 1.0 AS p, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS c FROM orders
         UNION ALL SELECT 'S2', count(*) FILTER (WHERE o_orderstatus = 'F') / 1e9, count(*) / 1e9 FROM orders)
       SELECT unique_id, round(p, 9) AS previous_result, round(c, 9) AS current_result,
              CAST(trunc((c - p) * 100 / p) AS BIGINT) AS pct_change,
              CASE WHEN trunc((c - p) * 100 / p) > 20 OR trunc((c - p) * 100 / p) < -5 THEN 'Fail' ELSE 'Pass' END AS status
       FROM k""",
)
def kpi_pre_post_fraction(spark, sf_dir):
    """Shares and rates below 1 are compared with all their decimals."""
    orders = demo.table(spark, sf_dir, "orders")
    entries = [_share_entry(u, q) for u, q in _SHARES.items()]
    tables = ({"run_orders": orders.where("o_orderstatus = 'F'")}, {"run_orders": orders})
    result = _second_run(spark, entries, *tables)
    return result.select(
        "unique_id", *[F.round(F.col(c).cast("double"), 9).alias(c) for c in ("previous_result", "current_result")], "pct_change", "status"
    )


_TYPES = {
    "T1": "SELECT max(o_orderdate) FROM run_orders",
    "T2": "SELECT min(o_orderpriority) FROM run_orders",
    "T3": "SELECT count(*) / 1e10D FROM run_orders",
}


@query(
    "kpi_result_types",
    """SELECT 'T1' AS unique_id, CAST(NULL AS DOUBLE) AS current_result,
              strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS result_text FROM orders
       UNION ALL SELECT 'T2', NULL, min(o_orderpriority) FROM orders
       UNION ALL SELECT 'T3', count(*) / 1e10, NULL FROM orders""",
)
def kpi_result_types(spark, sf_dir):
    """KPIs that are dates or texts are kept as text; small numbers keep their decimals."""
    demo.table(spark, sf_dir, "orders").createOrReplaceTempView("run_orders")
    cfg = demo.config(spark, [_share_entry(u, q, n.KPI_RESULT) for u, q in _TYPES.items()])
    result = plan_run(spark, cfg, Locations(layers={}), demo.CONTEXT)
    number = F.col("current_result").cast("double")
    return result.select("unique_id", number.alias("current_result"), F.when(number.isNull(), F.col("result_text")).alias("result_text"))


@query(
    "run_saved",
    over_result(
        "SELECT stage, check_type, CAST(2 AS BIGINT) AS n_runs, count(*) AS n_audit, "
        "count(*) FILTER (WHERE status = 'Pass') AS n_pass FROM check_result "
        "WHERE stage IN ('Silver data check', 'Gold data check') GROUP BY stage, check_type"
    ),
)
def run_saved(spark, sf_dir):
    """Two stages run and stored twice under one run id: the history holds each audit row once."""
    demo.register(spark, sf_dir)
    output = Output(scratch_dir(spark, "saved"))
    rows = [r for r in demo.ROWS if r["StageName"] in (n.STAGE_SILVER, n.STAGE_GOLD)]
    for _ in range(2):
        run_and_save(spark, demo.config(spark, rows), demo.locations(sf_dir), demo.CONTEXT, output)
    history = history_store.read_history(spark, output.history)
    return history.groupBy(F.col("STG_NM").alias("stage"), F.col("VLDTN_CHCK_TYP").alias("check_type")).agg(
        F.lit(2).cast("long").alias("n_runs"),
        F.count(F.lit(1)).alias("n_audit"),
        F.count_if(F.col("VLDTN_RSLT") == n.PASS).alias("n_pass"),
    )

"""Explicit schemas: configuration input, run state, results and audit history."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the check configuration file; every column is text.
CONFIG_COLUMNS = (
    "PipelineName",
    "StageName",
    "Check_Status",
    "ValidationCheck",
    "IsStageDependency",
    "DestinationLocationType",
    "SourceLocationType",
    "RowCountTableName",
    "RowCountTableLocation",
    "SourceTableName",
    "SourceTableLocation",
    "DestinationTableName",
    "DestinationTableLocation",
    "columns_list",
    "unexpected_list",
    "SLAThreshold",
    "DestinationLayer",
    "SourceLayer",
    "UniqueID",
    "KPIName",
    "AggregateFunction",
    "SourceQuery",
    "DestinationQuery",
)

CONFIG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CONFIG_COLUMNS])

# Numbers are kept with twelve decimals; the text form beside them keeps what does not fit.
RESULT_TYPE = T.DecimalType(38, 12)

# One metric of one check, before it is judged. `side` tells the two halves of
# a comparison apart.
METRIC_SCHEMA = (
    "check_id int, side string, total_rows bigint, unexpected_rows bigint, "
    "unexpected_keys bigint, value decimal(38,12), value_text string, as_of_max timestamp, error string"
)

STATE_SCHEMA = (
    "pipeline string, stage string, check_type string, layer string, state_key string, "
    "result decimal(38,12), run_ts timestamp"
)
STATE_KEYS = ["pipeline", "stage", "check_type", "layer", "state_key"]

# Long result of a run: one row per check item. Details, summaries, history,
# gate and report are projections of it.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("task_id", T.LongType()),
        T.StructField("pipeline", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("check_id", T.IntegerType()),
        T.StructField("layer", T.StringType()),
        T.StructField("src_layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("src_table", T.StringType()),
        T.StructField("dest_table", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("unexpected_value", T.StringType()),
        T.StructField("unique_id", T.StringType()),
        T.StructField("kpi_name", T.StringType()),
        T.StructField("agg_function", T.StringType()),
        T.StructField("src_query", T.StringType()),
        T.StructField("dest_query", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("unexpected_rows", T.LongType()),
        T.StructField("unexpected_keys", T.LongType()),
        T.StructField("previous_result", RESULT_TYPE),
        T.StructField("current_result", RESULT_TYPE),
        # A KPI as the engine prints it: also dates, texts and numbers beyond the decimal.
        T.StructField("result_text", T.StringType()),
        T.StructField("pct_change", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("on_stage_depend", T.IntegerType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# Columns of the audit history, in order.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("JOB_ID", T.LongType()),
        T.StructField("TSK_ID", T.LongType()),
        T.StructField("PPLN_NM", T.StringType()),
        T.StructField("STG_NM", T.StringType()),
        T.StructField("VLDTN_CHCK_TYP", T.StringType()),
        T.StructField("SRC_LAYR", T.StringType()),
        T.StructField("DEST_LAYR", T.StringType()),
        T.StructField("TBL_NM", T.StringType()),
        T.StructField("AGGR_FNCTN", T.StringType()),
        T.StructField("ROW_CNT", T.LongType()),
        T.StructField("SRC_TBL_NM", T.StringType()),
        T.StructField("DEST_TBL_NM", T.StringType()),
        T.StructField("SRC_RSLT", T.LongType()),
        T.StructField("DEST_RSLT", T.LongType()),
        T.StructField("COL_NM", T.StringType()),
        T.StructField("UNXPCTD_VAL", T.StringType()),
        T.StructField("KPI_RSLT", T.LongType()),
        T.StructField("POST_RUN_RSLT", T.LongType()),
        T.StructField("PRE_RUN_RSLT", T.LongType()),
        T.StructField("VLDTN_RSLT", T.StringType()),
        T.StructField("CRTD_BY", T.StringType()),
        T.StructField("CRTD_TM", T.TimestampType()),
        T.StructField("ON_STG_DPND", T.IntegerType()),
    ]
)

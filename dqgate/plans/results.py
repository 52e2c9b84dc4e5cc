"""Details, summaries, audit history, gate and report: projections of the long result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate import names as n
from dqgate.functions.formatting import heading, number_text, thousands, validated_on
from dqgate.functions.sizes import broadcast_if_small
from dqgate.functions.threshold import whole
from dqgate.plans.checks import active_checks, check_items
from dqgate.schemas import AUDIT_SCHEMA, RESULT_SCHEMA
from dqgate.sources.locations import LayerStore

_ON = {"Validated_On": lambda: validated_on(F.col("created_at"))}
_RESULT = {"Validation_Result": lambda: F.col("status")}


def _col(name: str):
    return lambda: F.col(name)


def _count(name: str):
    return lambda: thousands(F.coalesce(F.col(name), F.lit(0)).cast("bigint"))


def _value(name: str):
    return lambda: number_text(F.col(name))


_QUALITY_DETAIL = {
    "Tables_Name": _col("table_name"),
    **_ON,
    "Column_Name": _col("column_name"),
    **_RESULT,
}

# Columns of the detail table of each category, in order.
DETAIL_COLUMNS: dict[str, dict] = {
    n.CAT_ROW_COUNT: {
        "Table_Name": _col("table_name"),
        **_ON,
        "Row_Count": _count("current_result"),
        **_RESULT,
    },
    n.CAT_SOURCE_DESTINATION: {
        "Source_Table_Name": _col("src_table"),
        "Destination_Table_Name": _col("dest_table"),
        **_ON,
        "Source_Row_Count": _count("previous_result"),
        "Destination_Row_Count": _count("current_result"),
        **_RESULT,
    },
    n.CAT_NULL: _QUALITY_DETAIL,
    n.CAT_UNIQUE: _QUALITY_DETAIL,
    n.CAT_SLA: _QUALITY_DETAIL,
    n.CAT_FOREIGN_KEY: {
        "Tables_Name": _col("table_name"),
        "Dimension_Table_Name": _col("dest_table"),
        **_ON,
        "Column_Name": _col("column_name"),
        **_RESULT,
    },
    n.CAT_UNEXPECTED: {
        "Tables_Name": _col("table_name"),
        **_ON,
        "Column_Name": _col("column_name"),
        "Unexpected_Value": _col("unexpected_value"),
        **_RESULT,
    },
    n.CAT_PRE_POST: {
        "Layer": _col("layer"),
        "Table_Name": _col("table_name"),
        **_ON,
        "Previous_Row_Count": _count("previous_result"),
        "Current_Row_count": _count("current_result"),
        **_RESULT,
    },
    n.CAT_KPI_PRE_POST: {
        "KPI_Name": _col("kpi_name"),
        "Table_Name": _col("table_name"),
        "Layer": _col("layer"),
        "Query": _col("dest_query"),
        "Aggregate_Function": _col("agg_function"),
        **_ON,
        "Previous_Result": lambda: F.coalesce(number_text(F.col("previous_result")), F.lit("0")),
        "Current_Result": _value("current_result"),
        **_RESULT,
    },
    n.CAT_KPI_SOURCE_DESTINATION: {
        "KPI_Name": _col("kpi_name"),
        "Source_Table_Name": _col("src_table"),
        "Destination_Table_Name": _col("dest_table"),
        "Source_Layer": _col("src_layer"),
        "Destination_Layer": _col("layer"),
        "Source_Query": _col("src_query"),
        "Destination_Query": _col("dest_query"),
        "Aggregate_Function": _col("agg_function"),
        **_ON,
        "Source_Result": _value("previous_result"),
        "Destination_Result": _value("current_result"),
        **_RESULT,
    },
    n.CAT_KPI_RESULT: {
        "KPI_Name": _col("kpi_name"),
        "Table_Name": _col("table_name"),
        "Query": _col("dest_query"),
        "Aggregate_Function": _col("agg_function"),
        **_ON,
        "KPI_Result": lambda: F.coalesce(number_text(F.col("current_result")), F.col("result_text")),
    },
}


def detail(result: DataFrame, category: str) -> DataFrame:
    """The detail table of one category."""
    columns = DETAIL_COLUMNS[category]
    return result.where(F.col("category") == category).select(
        *[make().alias(name) for name, make in columns.items()]
    )


# ---- summaries -------------------------------------------------------------


def _tables_passed(result: DataFrame, *groups: str) -> DataFrame:
    """One row per table (or pair of tables); it passes when all its checks do."""
    table = F.concat_ws("->", F.coalesce("src_table", F.lit("")), F.coalesce("table_name", "dest_table"))
    return result.groupBy(*groups, table.alias("checked")).agg(
        F.bool_and(F.coalesce(F.col("status") == n.PASS, F.lit(False))).alias("passed")
    )


def _tally(tables: DataFrame, *groups: str) -> DataFrame:
    return tables.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("Total_Tables"),
        F.count_if("passed").alias("Passed"),
        F.count_if(~F.col("passed")).alias("Failed"),
    )


def summary_by_category(result: DataFrame) -> DataFrame:
    """Tables checked, passed and failed per row-count and data-quality category."""
    layered = result.where(F.col("family").isin(n.FAMILY_ROW_COUNT, n.FAMILY_QUALITY)).where(
        F.col("category").isNotNull()
    )
    return _tally(
        _tables_passed(layered, "pipeline", "stage", "category"), "pipeline", "stage", "category"
    ).select(
        "pipeline",
        "stage",
        F.col("category").alias("Validation_Category"),
        "Total_Tables",
        "Passed",
        "Failed",
    )


def summary_by_layer(result: DataFrame, stores: Mapping[str, LayerStore]) -> DataFrame:
    """Pre/post row counts: tables per layer, with where the layer is stored."""
    pre_post = result.where(F.col("category") == n.CAT_PRE_POST)
    tally = _tally(_tables_passed(pre_post, "pipeline", "layer"), "pipeline", "layer")

    def stored(attribute: str) -> Column:
        value = F.lit(None).cast("string")
        for layer, store in stores.items():
            value = F.when(F.lower("layer") == layer.lower(), getattr(store, attribute)).otherwise(value)
        return value

    return tally.select(
        "pipeline",
        F.col("layer").alias("Layer"),
        stored("container").alias("Container"),
        stored("account").alias("Storage_Account"),
        "Total_Tables",
        "Passed",
        "Failed",
    )


def kpi_summary(result: DataFrame) -> DataFrame:
    """Kinds of KPI checks that were run."""
    return (
        result.where(F.col("family") == n.FAMILY_KPI)
        .where(F.col("category").isNotNull())
        .select("pipeline", F.col("category").alias("Validation_Checks"))
        .distinct()
    )


def summary_all(result: DataFrame, stores: Mapping[str, LayerStore]) -> DataFrame:
    """Every summary in one shape: scope, category or layer, and its tallies."""
    by_category = summary_by_category(result).select(
        "pipeline", F.col("stage"), F.col("Validation_Category").alias("Scope"),
        "Total_Tables", "Passed", "Failed",
    )
    by_layer = summary_by_layer(result, stores).select(
        "pipeline", F.lit(n.STAGE_PRE_POST).alias("stage"), F.col("Layer").alias("Scope"),
        "Total_Tables", "Passed", "Failed",
    )
    nothing = F.lit(None).cast("bigint")
    kinds = kpi_summary(result).select(
        "pipeline", F.lit(n.STAGE_KPI).alias("stage"), F.col("Validation_Checks").alias("Scope"),
        nothing.alias("Total_Tables"), nothing.alias("Passed"), nothing.alias("Failed"),
    )
    return by_category.unionByName(by_layer).unionByName(kinds)


# ---- history ---------------------------------------------------------------


def stage_dep_overlay(rows: DataFrame, config: DataFrame) -> DataFrame:
    """Sets `ON_STG_DPND` from the active checks by table and check; 0 where there is none.

    One join, however many configured checks there are. Only flagged checks take
    part in it; they are broadcast if they measure small, so that the history
    stays where it is.
    """
    flags = (
        check_items(active_checks(config))
        .select(
            # As the history names it: a foreign key by its fact table.
            F.when(F.col("category") == n.CAT_FOREIGN_KEY, F.col("src_table")).otherwise(F.col("table_name")).alias("TBL_NM"),
            F.col("check_type").alias("VLDTN_CHCK_TYP"),
            F.col("on_stage_depend").alias("_dep"),
        )
        .where("_dep <> 0")
        .groupBy("TBL_NM", "VLDTN_CHCK_TYP")
        .agg(F.max("_dep").alias("_dep"))
    )
    joined = rows.drop("ON_STG_DPND").join(
        broadcast_if_small(flags), ["TBL_NM", "VLDTN_CHCK_TYP"], "left"
    )
    return joined.select(
        *[
            F.coalesce("_dep", F.lit(0)).alias(c) if c == "ON_STG_DPND" else F.col(c)
            for c in dict.fromkeys([*rows.columns, "ON_STG_DPND"])
        ]
    )


def audit_typed(df: DataFrame) -> DataFrame:
    """Audit rows in their stated types; the text `NULL` becomes a real null.

    Numeric texts with a fraction lose it.
    """

    def typed(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, T.StringType):
            col = F.when(F.lower(col) != "null", col)
        if isinstance(field.dataType, T.LongType) and isinstance(
            df.schema[field.name].dataType, T.StringType
        ):
            col = whole(col.try_cast("decimal(38,12)"))
        return col.try_cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in AUDIT_SCHEMA.fields])


def audit_history(result: DataFrame) -> DataFrame:
    """One audit record per check item, in the fixed columns of the history."""
    category = F.col("category")
    pairs = category.isin(n.CAT_SOURCE_DESTINATION, n.CAT_KPI_SOURCE_DESTINATION)
    reruns = category.isin(n.CAT_PRE_POST, n.CAT_KPI_PRE_POST)
    layered = category.isin(n.CAT_KPI_SOURCE_DESTINATION) | reruns
    number = lambda c: whole(F.col(c)).try_cast("bigint")
    values = {
        "JOB_ID": F.col("job_id"),
        "TSK_ID": F.col("task_id"),
        "PPLN_NM": F.col("pipeline"),
        "STG_NM": F.col("stage"),
        "VLDTN_CHCK_TYP": F.col("check_type"),
        "SRC_LAYR": F.when(category == n.CAT_KPI_SOURCE_DESTINATION, F.col("src_layer")),
        "DEST_LAYR": F.when(layered, F.col("layer")),
        "TBL_NM": F.col("table_name"),
        "AGGR_FNCTN": F.col("agg_function"),
        "ROW_CNT": F.when(category == n.CAT_ROW_COUNT, number("current_result")),
        "SRC_TBL_NM": F.col("src_table"),
        "DEST_TBL_NM": F.col("dest_table"),
        "SRC_RSLT": F.when(pairs, number("previous_result")),
        "DEST_RSLT": F.when(pairs, number("current_result")),
        "COL_NM": F.when(F.col("family") == n.FAMILY_QUALITY, F.col("column_name")),
        "UNXPCTD_VAL": F.col("unexpected_value"),
        "KPI_RSLT": F.when(category == n.CAT_KPI_RESULT, number("current_result")),
        "POST_RUN_RSLT": F.when(reruns, number("current_result")),
        "PRE_RUN_RSLT": F.when(reruns, number("previous_result")),
        "VLDTN_RSLT": F.col("status"),
        "CRTD_BY": F.col("created_by"),
        "CRTD_TM": F.col("created_at"),
        "ON_STG_DPND": F.col("on_stage_depend"),
    }
    return result.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA.fields]
    )


# ---- gate and report -------------------------------------------------------


def stage_gate(result: DataFrame) -> DataFrame:
    """Per pipeline and stage: may what depends on it go on, and if not, why not.

    A check that failed or could not be run blocks when it is flagged.
    """
    stops = F.col("status").isin(n.FAIL, n.ERROR) & (F.col("on_stage_depend") != 0)
    place = F.coalesce("table_name", F.concat_ws("->", "src_table", "dest_table"))
    reason = F.concat_ws(" ", F.coalesce("category", "check_type", "error"), place, "column_name")
    return result.groupBy("pipeline", "stage").agg(
        F.coalesce(F.bool_or(stops), F.lit(False)).alias("blocked"),
        F.count_if(stops).alias("blocking_checks"),
        F.array_join(F.array_sort(F.collect_set(F.when(stops, reason))), "; ").alias("reasons"),
    )


def _numbered(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows numbered within their pipeline and stage, under readable headings."""
    order = Window.partitionBy("pipeline", "stage").orderBy(*columns)
    number = F.row_number().over(order).cast("bigint")
    shown = ["pipeline", "stage", *columns]
    return rows.select(number.alias("#"), *[F.col(c).alias(heading(c[:1].upper() + c[1:])) for c in shown])


def report_rows(result: DataFrame, category: str) -> DataFrame:
    """Detail rows of a category, numbered for the report of each pipeline and stage."""
    columns = DETAIL_COLUMNS[category]
    chosen = result.where(F.col("category") == category)
    rows = chosen.select("pipeline", "stage", *[make().alias(name) for name, make in columns.items()])
    return _numbered(rows, list(columns))


def report_summary(result: DataFrame, stores: Mapping[str, LayerStore]) -> DataFrame:
    """Rows of all summaries, numbered for the report of each pipeline and stage."""
    return _numbered(summary_all(result, stores), ["Scope", "Total_Tables", "Passed", "Failed"])


def error_rows(result: DataFrame) -> DataFrame:
    """Checks that could not be run, with the reason."""
    return result.where(F.col("status") == n.ERROR)


def typed_result(df: DataFrame) -> DataFrame:
    """A stored result in the columns and types of `RESULT_SCHEMA`."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RESULT_SCHEMA.fields])

"""From the configuration file to one typed row per check item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqgate import names as n

ITEM_COLUMNS = (
    "pipeline string, stage string, family string, check_type string, category string, "
    "on_stage_depend int, item_pos int, layer string, src_layer string, "
    "location_type string, table_name string, location string, "
    "src_location_type string, src_table string, src_location string, "
    "columns array<string>, dest_column string, unexpected_values array<string>, "
    "sla_threshold double, unique_id string, kpi_name string, agg_function string, "
    "src_query string, dest_query string, error string"
)


# ---- selecting and routing -------------------------------------------------


def active_checks(
    config: DataFrame, pipeline: str | None = None, stage: str | None = None
) -> DataFrame:
    """Checks switched on with `yes`, optionally of one pipeline and stage."""
    chosen = F.col("Check_Status") == "yes"
    if pipeline is not None:
        chosen = chosen & (F.col("PipelineName") == pipeline)
    if stage is not None:
        chosen = chosen & (F.col("StageName") == stage)
    return config.where(chosen)


def family_of(stage: Column, check: Column) -> Column:
    """Pre/post and KPI stages own all their checks; elsewhere the check decides."""
    return (
        F.when(stage == n.STAGE_PRE_POST, n.FAMILY_PRE_POST)
        .when(stage == n.STAGE_KPI, n.FAMILY_KPI)
        .when(check.isin(n.ROW_COUNT, n.SOURCE_DESTINATION), n.FAMILY_ROW_COUNT)
        .otherwise(n.FAMILY_QUALITY)
    )


def routed(config: DataFrame) -> DataFrame:
    """Configuration with the `family` each row belongs to."""
    return config.withColumn("family", family_of(F.col("StageName"), F.col("ValidationCheck")))


def slice_of(config: DataFrame, **equal: str) -> DataFrame:
    """Rows of one check, table, layer or any other combination of column values."""
    for column, value in equal.items():
        config = config.where(F.col(column) == value)
    return config


def runs_of(config: DataFrame) -> DataFrame:
    """The (pipeline, stage) pairs that have active checks."""
    return active_checks(config).select("PipelineName", "StageName").distinct()


# ---- parameter lists -------------------------------------------------------

_IS_JSON = "ltrim({0}) LIKE '[%'"
_ITEMS = (
    f"CASE WHEN {_IS_JSON} THEN from_json({{0}}, 'array<string>') ELSE split({{0}}, ',') END"
)
_GROUPS = (
    f"CASE WHEN {_IS_JSON} THEN from_json({{0}}, 'array<array<string>>') "
    "ELSE transform(split({0}, ',,'), g -> split(g, ',')) END"
)


def items_of(column: str) -> Column:
    """`a,b` or `["a","b"]` as an array of items; null stays null."""
    return F.expr(_ITEMS.format(column))


def groups_of(column: str) -> Column:
    """`a,b,,c` or `[["a","b"],["c"]]` as an array of groups of items.

    An empty item cannot be told from a group separator in the comma form; use
    the JSON form for it.
    """
    return F.expr(_GROUPS.format(column))


def tables_of(column: str) -> Column:
    """Parts for different tables, separated by `,,,`."""
    return F.split(column, ",,,")


# ---- one row per check item ------------------------------------------------
#
# Written as SQL text: a statement of this size is parsed in one go, where a
# tree of Column objects costs one call into the JVM per node.


def _in(*values: str) -> str:
    return "({})".format(", ".join(f"'{v}'" for v in values))


_QUALITY = f"family = '{n.FAMILY_QUALITY}'"
_IS_FK = f"({_QUALITY} AND ValidationCheck = '{n.FOREIGN_KEY}')"
_IS_UNEXPECTED = f"({_QUALITY} AND ValidationCheck = '{n.UNEXPECTED}')"
_IS_SLA = f"({_QUALITY} AND ValidationCheck = '{n.SLA}')"
_NEEDS_COLUMNS = (
    f"({_QUALITY} AND ValidationCheck IN "
    f"{_in(n.NULL, n.UNIQUE, n.UNEXPECTED, n.FOREIGN_KEY, n.SLA)})"
)
_COUNTED = (
    f"(family = '{n.FAMILY_PRE_POST}' OR "
    f"(family = '{n.FAMILY_ROW_COUNT}' AND ValidationCheck = '{n.ROW_COUNT}'))"
)
# Every row of the pre/post stage is a pre/post check, whatever it is called.
_CATEGORY = (
    f"CASE WHEN family = '{n.FAMILY_PRE_POST}' THEN '{n.CAT_PRE_POST}' ELSE map("
    + ", ".join(f"'{f}/{c}', '{category}'" for (f, c), category in n.CATEGORY_OF.items())
    + ")[concat_ws('/', family, ValidationCheck)] END"
)

_PARSED = {
    "category": _CATEGORY,
    "_columns": _ITEMS.format("columns_list"),
    "_values": _GROUPS.format("unexpected_list"),
    "_facts": _ITEMS.format("SourceTableName"),
    "_dims": _ITEMS.format("DestinationTableName"),
    "_fact_places": _ITEMS.format("SourceTableLocation"),
    "_dim_places": _ITEMS.format("DestinationTableLocation"),
}
_KEY_SETS = f"""
    CASE WHEN {_QUALITY} AND ValidationCheck IN {_in(n.NULL, n.UNEXPECTED, n.FOREIGN_KEY)}
         THEN transform(_columns, c -> array(c))
         WHEN {_QUALITY} AND ValidationCheck = '{n.UNIQUE}' THEN {_GROUPS.format("columns_list")}
         ELSE array(CASE WHEN columns_list IS NOT NULL THEN array(columns_list) END) END"""


def _differ(*lists: str) -> str:
    sizes = [f"coalesce(size({x}), 0)" for x in lists]
    return " OR ".join(f"{sizes[0]} <> {other}" for other in sizes[1:])


def flag_sql(column: str) -> str:
    """A yes/no setting as 1 or 0; null where it is neither. Nothing said means no."""
    text = f"lower(trim({column}))"
    return (
        f"CASE WHEN {column} IS NULL OR {text} IN ('', '0', 'no', 'n', 'false') THEN 0 "
        f"WHEN {text} IN ('yes', 'y', 'true') OR try_cast({text} AS int) <> 0 THEN 1 END"
    )


_ERROR = f"""
    CASE WHEN {flag_sql("IsStageDependency")} IS NULL
         THEN concat('IsStageDependency is neither yes nor no: ', IsStageDependency)
         WHEN category IS NULL THEN concat('unknown check: ', coalesce(ValidationCheck, '(none)'))
         WHEN {_NEEDS_COLUMNS} AND columns_list IS NULL THEN 'columns_list is empty'
         WHEN {_NEEDS_COLUMNS} AND _key_sets IS NULL THEN 'columns_list is not readable'
         WHEN {_IS_UNEXPECTED} AND ({_differ("_columns", "_values")})
         THEN 'columns_list and unexpected_list differ in length'
         WHEN {_IS_FK} AND ({_differ("_columns", "_dims", "_facts", "_dim_places", "_fact_places")})
         THEN 'foreign key tables, locations and columns differ in length'
         WHEN {_IS_SLA} AND try_cast(SLAThreshold AS double) IS NULL
         THEN 'SLAThreshold is not a number' END"""

_USABLE_FK = f"({_IS_FK} AND error IS NULL)"


def _placed(counted: str, of_pair: str, otherwise: str) -> str:
    return (
        f"CASE WHEN {_COUNTED} THEN {counted} "
        f"WHEN {_USABLE_FK} THEN trim(get({of_pair}, item_pos)) ELSE {otherwise} END"
    )


def _of_fact(of_pair: str, otherwise: str) -> str:
    return f"CASE WHEN {_USABLE_FK} THEN trim(get({of_pair}, item_pos)) ELSE {otherwise} END"


_ARROW = "split(get(_key, 0), '->')"
_ITEM = {
    "pipeline": "PipelineName",
    "stage": "StageName",
    "family": "family",
    "check_type": f"CASE WHEN family = '{n.FAMILY_PRE_POST}' THEN '{n.PRE_POST}' ELSE ValidationCheck END",
    "category": "category",
    # What cannot be read might be meant to block, so it does.
    "on_stage_depend": f"coalesce({flag_sql('IsStageDependency')}, 1)",
    "item_pos": "item_pos",
    "layer": "DestinationLayer",
    "src_layer": "SourceLayer",
    "location_type": "DestinationLocationType",
    "table_name": _placed("RowCountTableName", "_dims", "DestinationTableName"),
    "location": _placed("RowCountTableLocation", "_dim_places", "DestinationTableLocation"),
    "src_location_type": "coalesce(SourceLocationType, DestinationLocationType)",
    "src_table": _of_fact("_facts", "SourceTableName"),
    "src_location": _of_fact("_fact_places", "SourceTableLocation"),
    "columns": f"CASE WHEN {_USABLE_FK} THEN array(trim(get({_ARROW}, 0))) "
    "WHEN error IS NOT NULL AND columns_list IS NOT NULL THEN array(columns_list) "
    "ELSE transform(_key, c -> trim(c)) END",
    "dest_column": f"CASE WHEN {_USABLE_FK} THEN trim(coalesce(get({_ARROW}, 1), get({_ARROW}, 0))) END",
    "unexpected_values": f"CASE WHEN {_IS_UNEXPECTED} THEN get(_values, item_pos) END",
    "sla_threshold": "try_cast(SLAThreshold AS double)",
    "unique_id": "UniqueID",
    "kpi_name": "KPIName",
    "agg_function": "AggregateFunction",
    "src_query": "SourceQuery",
    "dest_query": "DestinationQuery",
    "error": "error",
}


def check_items(config: DataFrame) -> DataFrame:
    """One typed row per check item (`ITEM_COLUMNS`), explaining what it cannot use in `error`.

    A null check has one item per column, a unique check one per key, an
    unexpected-value check one per column with its group of values, a foreign
    key check one per pair of tables and columns. `fact->dim` names a
    dimension column that differs from the fact column. A row with an error
    stays one row and is reported as such.
    """
    return (
        routed(config)
        .selectExpr(
            *[f"CASE WHEN trim({c}) <> '' THEN {c} END AS {c}" for c in config.columns], "family"
        )
        .selectExpr("*", *[f"{sql} AS {name}" for name, sql in _PARSED.items()])
        .selectExpr("*", f"{_KEY_SETS} AS _key_sets")
        .selectExpr("*", f"{_ERROR} AS error")
        .selectExpr(
            "*", "posexplode_outer(CASE WHEN error IS NULL THEN _key_sets END) AS (_pos, _key)"
        )
        .selectExpr("*", "coalesce(_pos, 0) AS item_pos")
        .selectExpr(*[f"{sql} AS {name}" for name, sql in _ITEM.items()])
    )

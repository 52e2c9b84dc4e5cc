"""Reading, selecting and exploding configurations.

The configuration here is derived from the `part` table, one row per part, so
that it is as large as the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.plans import checks
from dqgate.schemas import CONFIG_COLUMNS
from dqgate.session import scratch_dir
from dqgate.sources.config_csv import read_check_config
from workload import demo
from workload.registry import query

# One statement for both engines.
_DERIVED = {
    "PipelineName": "concat('PL_', p_brand)",
    "StageName": """CASE p_partkey % 6 WHEN 0 THEN 'Bronze data check' WHEN 1 THEN 'Silver data check'
        WHEN 2 THEN 'Gold data check' WHEN 3 THEN 'Synapse data check'
        WHEN 4 THEN 'Pre and post runs rowcount check' ELSE 'KPI data check' END""",
    "Check_Status": """CASE WHEN p_partkey % 7 = 0 THEN 'no' WHEN p_partkey % 11 = 0 THEN 'Yes'
        ELSE 'yes' END""",
    "ValidationCheck": """CASE WHEN p_partkey % 6 = 4 THEN 'PrePostRowcountCheck'
        WHEN p_partkey % 6 = 5 THEN 'KPIResultCheck'
        WHEN p_size % 7 = 0 THEN 'RowCount' WHEN p_size % 7 = 1 THEN 'SourceDestinationRowcountResult'
        WHEN p_size % 7 = 2 THEN 'NullCheck' WHEN p_size % 7 = 3 THEN 'UniqueCheck'
        WHEN p_size % 7 = 4 THEN 'UnExpectedList' WHEN p_size % 7 = 5 THEN 'ForeignKeyCheck'
        ELSE 'SLACheck' END""",
    "IsStageDependency": "CASE WHEN p_size % 2 = 0 THEN '1' ELSE '0' END",
    "DestinationLocationType": "CASE p_partkey % 3 WHEN 0 THEN 'ADLS' WHEN 1 THEN 'ADB_SQL' ELSE 'Synapse' END",
    "RowCountTableName": "concat('T', CAST(p_partkey AS VARCHAR(20)))",
    "RowCountTableLocation": "concat('/tables/t', CAST(p_partkey AS VARCHAR(20)))",
    "SourceTableName": "concat('F', CAST(p_partkey AS VARCHAR(20)))",
    "SourceTableLocation": "concat('/facts/f', CAST(p_partkey AS VARCHAR(20)))",
    "DestinationTableName": "concat('T', CAST(p_partkey AS VARCHAR(20)))",
    "DestinationTableLocation": "concat('/tables/t', CAST(p_partkey AS VARCHAR(20)))",
    "columns_list": """CASE WHEN p_size % 7 = 2 THEN concat('id,c', CAST(p_size AS VARCHAR(20)), ',name')
        WHEN p_size % 7 = 3 THEN concat('id,,c', CAST(p_size AS VARCHAR(20)), ',name')
        WHEN p_size % 7 = 4 THEN 'status,kind' WHEN p_size % 7 = 5 THEN 'fk'
        WHEN p_size % 7 = 6 THEN 'ts' END""",
    "unexpected_list": """CASE WHEN p_size % 7 = 4 AND p_partkey % 5 = 0 THEN 'X'
        WHEN p_size % 7 = 4 THEN concat('X,Z,,', p_brand, ',n/a') END""",
    "SLAThreshold": "CASE WHEN p_size % 7 = 6 THEN CAST(p_size AS VARCHAR(20)) END",
    "DestinationLayer": "CASE p_partkey % 3 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' ELSE 'Gold' END",
    "UniqueID": "concat('U', CAST(p_partkey AS VARCHAR(20)))",
    "KPIName": "p_name",
    "AggregateFunction": "'SUM'",
    "DestinationQuery": """concat('SELECT "', p_type, '",', chr(10), ' count(*) FROM t -- ', p_name)""",
}
_CONFIG_SQL = "SELECT {} FROM part".format(
    ", ".join(
        f'{_DERIVED[c]} AS "{c}"' if c in _DERIVED else f'CAST(NULL AS VARCHAR(20)) AS "{c}"'
        for c in CONFIG_COLUMNS
    )
)


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.table(spark, sf_dir, "part").select(
        *[
            (F.expr(_DERIVED[c]) if c in _DERIVED else F.lit(None)).cast("string").alias(c)
            for c in CONFIG_COLUMNS
        ]
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived configuration, written as CSV in another column order, without one optional
    column and with one too many, and read back."""
    folder = scratch_dir(spark, "config")
    derived = _derived(spark, sf_dir)
    unused = next(c for c in CONFIG_COLUMNS if c not in _DERIVED)
    shuffled = derived.select(F.lit("x").alias("Remark"), *[c for c in reversed(CONFIG_COLUMNS) if c != unused])
    shuffled.write.options(header=True, escape='"', quote='"').csv(folder)
    return read_check_config(spark, folder)


@query("read_check_config", _CONFIG_SQL)
def read_config(spark, sf_dir):
    return _stored(spark, sf_dir)


_ACTIVE = '"Check_Status" = \'yes\''


@query(
    "config_active",
    f'SELECT "PipelineName", "StageName", "UniqueID", "ValidationCheck" FROM ({_CONFIG_SQL}) '
    f"WHERE {_ACTIVE} AND \"StageName\" = 'Gold data check'",
)
def config_active(spark, sf_dir):
    chosen = checks.active_checks(_stored(spark, sf_dir), stage=n.STAGE_GOLD)
    return chosen.select("PipelineName", "StageName", "UniqueID", "ValidationCheck")


_FAMILY_SQL = """CASE WHEN "StageName" = 'Pre and post runs rowcount check' THEN 'pre_post'
    WHEN "StageName" = 'KPI data check' THEN 'kpi'
    WHEN "ValidationCheck" IN ('RowCount', 'SourceDestinationRowcountResult') THEN 'row_count'
    ELSE 'data_quality' END"""


@query(
    "config_route",
    f'SELECT "StageName", {_FAMILY_SQL} AS family, count(*) AS n_checks FROM ({_CONFIG_SQL}) '
    f"WHERE {_ACTIVE} GROUP BY ALL",
)
def config_route(spark, sf_dir):
    active = checks.active_checks(_stored(spark, sf_dir))
    return checks.routed(active).groupBy("StageName", "family").agg(
        F.count(F.lit(1)).alias("n_checks")
    )


@query(
    "config_by_group",
    f'SELECT "PipelineName", "DestinationTableName", "columns_list" FROM ({_CONFIG_SQL}) '
    "WHERE \"ValidationCheck\" = 'NullCheck' AND \"DestinationLayer\" = 'Silver'",
)
def config_by_group(spark, sf_dir):
    chosen = checks.slice_of(
        _stored(spark, sf_dir), ValidationCheck=n.NULL, DestinationLayer=n.SILVER
    )
    return chosen.select("PipelineName", "DestinationTableName", "columns_list")


@query(
    "config_runs",
    f'SELECT DISTINCT "PipelineName", "StageName" FROM ({_CONFIG_SQL}) WHERE {_ACTIVE}',
)
def config_runs(spark, sf_dir):
    return checks.runs_of(_stored(spark, sf_dir))


_EXPLODE_SQL = f"""
WITH cfg AS (SELECT *, {_FAMILY_SQL} AS family FROM ({_CONFIG_SQL}) WHERE {_ACTIVE}),
quality AS (SELECT *, string_split("columns_list", ',') AS cols,
                   string_split("columns_list", ',,') AS groups,
                   string_split("unexpected_list", ',,') AS vals
            FROM cfg WHERE family = 'data_quality'),
items AS (
  SELECT "UniqueID", "ValidationCheck", i AS item_pos, cols[i + 1] AS columns_text, NULL AS values_text,
         NULL AS error
  FROM quality, unnest(range(len(cols))) AS t(i) WHERE "ValidationCheck" = 'NullCheck'
  UNION ALL
  SELECT "UniqueID", "ValidationCheck", i, replace(groups[i + 1], ',', '|'), NULL, NULL
  FROM quality, unnest(range(len(groups))) AS t(i) WHERE "ValidationCheck" = 'UniqueCheck'
  UNION ALL
  SELECT "UniqueID", "ValidationCheck", i, cols[i + 1], replace(vals[i + 1], ',', '|'), NULL
  FROM quality, unnest(range(len(cols))) AS t(i)
  WHERE "ValidationCheck" = 'UnExpectedList' AND len(cols) = len(vals)
  UNION ALL
  SELECT "UniqueID", "ValidationCheck", 0, "columns_list", NULL,
         'columns_list and unexpected_list differ in length'
  FROM quality WHERE "ValidationCheck" = 'UnExpectedList' AND len(cols) <> len(vals)
  UNION ALL
  SELECT "UniqueID", "ValidationCheck", 0, "columns_list", NULL, NULL
  FROM quality WHERE "ValidationCheck" IN ('ForeignKeyCheck', 'SLACheck')
  UNION ALL
  SELECT "UniqueID", "ValidationCheck", 0, "columns_list", NULL, NULL FROM cfg WHERE family <> 'data_quality')
SELECT "UniqueID" AS unique_id, "ValidationCheck" AS check_type, CAST(item_pos AS INTEGER) AS item_pos,
       columns_text, values_text, error FROM items"""


@query("config_explode", _EXPLODE_SQL)
def config_explode(spark, sf_dir):
    items = checks.check_items(checks.active_checks(_stored(spark, sf_dir)))
    return items.select(
        "unique_id",
        "check_type",
        "item_pos",
        F.array_join("columns", "|").alias("columns_text"),
        F.when(F.col("error").isNull(), F.array_join("unexpected_values", "|")).alias("values_text"),
        "error",
    )

"""The demonstration configuration: checks over the given tables.

Its rows only say what to check; all work is done on the tables at `sf_dir`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.functions.formatting import session_time
from dqgate.operators.kpi import kpi_agg, kpi_sql
from dqgate.operators.metrics import row_counts
from dqgate.plans.run import RunContext, plan_run, union_all
from dqgate.schemas import CONFIG_COLUMNS, CONFIG_SCHEMA
from dqgate.sources.files import read_path, register_view
from dqgate.sources.locations import LayerStore, Locations

PIPELINE = "PL_DEMO"
AS_OF = dt.datetime(2024, 1, 31, 6, 0, 0)
PREVIOUS_RUN = dt.datetime(2024, 1, 30, 6, 0, 0)
CONTEXT = RunContext(as_of=AS_OF, job_id=7, task_id=11, created_by="demo", run_id="demo-run")

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "labels",
)

VIEWS = {
    "dirty_orders": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    WHEN o_orderkey % 89 = 0 THEN -1 ELSE o_custkey END AS o_custkey,
               CASE WHEN o_orderkey % 53 = 0 THEN 'X'
                    WHEN o_orderkey % 59 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "orders_prev": "SELECT * FROM orders WHERE o_orderkey % 10 <> 0",
    "lineitem_prev": "SELECT * FROM lineitem WHERE l_orderkey % 4 <> 0",
    "part_cur": "SELECT * FROM part WHERE p_partkey % 10 <> 0",
    "region_empty": "SELECT * FROM region WHERE false",
}

PRICE_QUERY = "SELECT sum(cast(o_totalprice AS decimal(18,2))) AS revenue FROM orders"
PART_QUERY = "SELECT sum(p_size) AS s FROM part_cur"
BUYERS_QUERY = "SELECT count(DISTINCT o_custkey) AS buyers FROM orders"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_path(spark, f"{sf_dir}/{name}.parquet")


_registered: dict[str, str] = {}


def register(spark: SparkSession, sf_dir: str) -> None:
    """The given tables and the views above, by name."""
    application = spark.sparkContext.applicationId
    if _registered.get(application) == sf_dir and spark.catalog.tableExists("dirty_orders"):
        return
    _registered[application] = sf_dir
    for name in TABLES:
        register_view(table(spark, sf_dir, name), name)
    for name, query in VIEWS.items():
        register_view(spark.sql(query), name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.table(name)


def locations(sf_dir: str) -> Locations:
    return Locations(
        layers={
            layer: LayerStore(f"{sf_dir}/", f"{layer.lower()}-container", f"{layer.lower()}-account")
            for layer in (n.BRONZE, n.SILVER, n.GOLD)
        }
    )


# ---- configuration rows ----------------------------------------------------


def _row(stage: str, check: str, depend: int = 0, **values: str) -> dict[str, str]:
    return {
        "PipelineName": PIPELINE,
        "StageName": stage,
        "Check_Status": "yes",
        "ValidationCheck": check,
        "IsStageDependency": str(depend),
        "DestinationLocationType": n.LOCATION_PATH,
        **values,
    }


def _place(name: str) -> tuple[str, str]:
    """Location type and location of a table or view of the demonstration."""
    return (n.LOCATION_CATALOG, name) if name in VIEWS else (n.LOCATION_PATH, f"{name}.parquet")


def _count_of(name: str, depend: int = 0, stage: str = n.STAGE_BRONZE, check: str = n.ROW_COUNT, **more):
    kind, place = _place(name)
    return _row(
        stage, check, depend, RowCountTableName=name, RowCountTableLocation=place,
        DestinationLocationType=kind, **more,
    )


def _on(name: str, stage: str, check: str, depend: int = 0, **more: str):
    kind, place = _place(name)
    return _row(
        stage, check, depend, DestinationTableName=name, DestinationTableLocation=place,
        **{"DestinationLocationType": kind, **more},
    )


def _from_to(source: str, target: str, stage: str, check: str, depend: int = 0, **more: str):
    kind, place = _place(source)
    return _on(
        target, stage, check, depend, SourceTableName=source, SourceTableLocation=place,
        **{"SourceLocationType": kind, **more},
    )


ROWS: tuple[dict[str, str], ...] = (
    # Bronze
    *[_count_of(t, int(t == "orders")) for t in TABLES[:8]],
    _count_of("region_empty"),
    _from_to("orders_prev", "orders", n.STAGE_BRONZE, n.SOURCE_DESTINATION, 1),
    _from_to("lineitem_prev", "lineitem", n.STAGE_BRONZE, n.SOURCE_DESTINATION),
    _from_to("customer", "customer", n.STAGE_BRONZE, n.SOURCE_DESTINATION),
    _from_to("part", "part_cur", n.STAGE_BRONZE, n.SOURCE_DESTINATION),
    _on("dirty_orders", n.STAGE_BRONZE, n.NULL, 1, columns_list="o_custkey,o_orderstatus,o_orderkey"),
    _on("dirty_orders", n.STAGE_BRONZE, n.UNEXPECTED, 0,
        columns_list="o_orderstatus,o_orderpriority", unexpected_list="X,Z,,9-NONE"),
    _on("lineitem", n.STAGE_BRONZE, n.UNIQUE, 1, columns_list="l_orderkey,l_linenumber"),
    _on("orders", n.STAGE_BRONZE, n.UNIQUE, 0, columns_list="o_orderkey"),
    _on("documents", n.STAGE_BRONZE, n.UNIQUE, 0, columns_list="text"),
    _from_to("dirty_orders", "customer", n.STAGE_BRONZE, n.FOREIGN_KEY, 1,
             columns_list="o_custkey->c_custkey"),
    _from_to("documents", "labels", n.STAGE_BRONZE, n.FOREIGN_KEY, 0, columns_list="doc_id"),
    _on("events", n.STAGE_BRONZE, n.SLA, 0, columns_list="ts", SLAThreshold="24"),
    _on("events", n.STAGE_BRONZE, n.SLA, 1, columns_list="ts", SLAThreshold="6"),
    {**_on("customer", n.STAGE_BRONZE, n.NULL, 1, columns_list="c_name"), "Check_Status": "no"},
    # Silver: nothing wrong
    _count_of("customer", 1, n.STAGE_SILVER),
    _on("customer", n.STAGE_SILVER, n.NULL, 1, columns_list="c_custkey,c_name"),
    # Gold: a table that is not there
    _on("no_such_table", n.STAGE_GOLD, n.NULL, 1, columns_list="id"),
    _on("supplier", n.STAGE_GOLD, n.UNIQUE, 1, columns_list="s_suppkey"),
    # Pre and post runs
    _count_of("orders", 1, n.STAGE_PRE_POST, n.PRE_POST, DestinationLayer=n.BRONZE),
    _count_of("lineitem", 1, n.STAGE_PRE_POST, n.PRE_POST, DestinationLayer=n.BRONZE),
    _count_of("customer", 0, n.STAGE_PRE_POST, n.PRE_POST, DestinationLayer=n.SILVER),
    _count_of("part_cur", 0, n.STAGE_PRE_POST, n.PRE_POST, DestinationLayer=n.SILVER),
    _count_of("region", 0, n.STAGE_PRE_POST, n.PRE_POST, DestinationLayer=n.SILVER),
    _count_of("region_empty", 0, n.STAGE_PRE_POST, n.PRE_POST, DestinationLayer=n.SILVER),
    # KPI
    _on("orders", n.STAGE_KPI, n.PRE_POST, 1, UniqueID="K1", KPIName="Revenue", AggregateFunction="SUM",
        DestinationLocationType=n.LOCATION_CATALOG, DestinationLayer=n.GOLD,
        columns_list="o_totalprice", DestinationQuery=PRICE_QUERY),
    _on("lineitem", n.STAGE_KPI, n.PRE_POST, 1, UniqueID="K2", KPIName="Lines",
        AggregateFunction="COUNT", DestinationLayer=n.SILVER, columns_list="l_orderkey"),
    _on("customer", n.STAGE_KPI, n.PRE_POST, 0, UniqueID="K3", KPIName="Last customer",
        AggregateFunction="MAX", DestinationLayer=n.SILVER, columns_list="c_custkey"),
    _from_to("part", "part_cur", n.STAGE_KPI, n.SOURCE_DESTINATION, 0, UniqueID="K4", KPIName="Sizes",
             AggregateFunction="SUM", SourceLayer=n.SILVER, DestinationLayer=n.GOLD,
             columns_list="p_size", DestinationQuery=PART_QUERY),
    _from_to("orders", "orders", n.STAGE_KPI, n.SOURCE_DESTINATION, 0, UniqueID="K5",
             KPIName="Orders", AggregateFunction="COUNT", SourceLayer=n.SILVER,
             DestinationLayer=n.GOLD, columns_list="o_orderkey"),
    _on("orders", n.STAGE_KPI, n.KPI_RESULT, 0, UniqueID="K6", KPIName="Key sum",
        AggregateFunction="SUM", DestinationLayer=n.GOLD, columns_list="o_custkey"),
    _on("orders", n.STAGE_KPI, n.KPI_RESULT, 0, UniqueID="K7", KPIName="Buyers",
        AggregateFunction="COUNT", DestinationLocationType=n.LOCATION_CATALOG,
        DestinationLayer=n.GOLD, columns_list="o_custkey", DestinationQuery=BUYERS_QUERY),
    _on("orders", n.STAGE_KPI, n.KPI_RESULT, 0, UniqueID="K8", KPIName="Buyers on path",
        AggregateFunction="COUNT_DISTINCT", DestinationLayer=n.GOLD, columns_list="o_custkey"),
)


def config(spark: SparkSession, rows: Sequence[dict[str, str]] = ROWS) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(c) for c in CONFIG_COLUMNS) for r in rows], CONFIG_SCHEMA)


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the previous run stored: results of the earlier tables and views."""
    register(spark, sf_dir)
    counted = {
        "orders": (n.BRONZE, "orders_prev"),
        "lineitem": (n.BRONZE, "lineitem_prev"),
        "customer": (n.SILVER, "customer"),
        "part_cur": (n.SILVER, "part"),
    }
    counts = union_all(
        [
            row_counts({key: spark.table(place)}).select(
                F.lit(n.STAGE_PRE_POST).alias("stage"),
                F.lit(layer).alias("layer"),
                F.col("table_name").alias("state_key"),
                F.col("row_count").cast("decimal(38,12)").alias("result"),
            )
            for key, (layer, place) in counted.items()
        ]
    )
    values = {
        "K1": (n.GOLD, kpi_sql(spark, PRICE_QUERY.replace("FROM orders", "FROM orders_prev"))),
        "K2": (n.SILVER, kpi_agg(spark.table("lineitem_prev"), "count", "l_orderkey")),
    }
    kpis = union_all(
        [
            value.select(
                F.lit(n.STAGE_KPI).alias("stage"),
                F.lit(layer).alias("layer"),
                F.lit(key).alias("state_key"),
                F.col("value").alias("result"),
            )
            for key, (layer, value) in values.items()
        ]
    )
    return counts.unionByName(kpis).select(
        F.lit(PIPELINE).alias("pipeline"),
        "stage",
        F.lit(n.PRE_POST).alias("check_type"),
        "layer",
        "state_key",
        "result",
        session_time(PREVIOUS_RUN).alias("run_ts"),
    )


def result(
    spark: SparkSession,
    sf_dir: str,
    checks: Sequence[str] | None = None,
    stages: Sequence[str] | None = None,
) -> DataFrame:
    """The long result of the demonstration, or of the chosen checks and stages."""
    register(spark, sf_dir)
    rows = [
        r
        for r in ROWS
        if (checks is None or r["ValidationCheck"] in checks)
        and (stages is None or r["StageName"] in stages)
    ]
    needs_state = any(r["ValidationCheck"] == n.PRE_POST for r in rows)
    return plan_run(
        spark,
        config(spark, rows),
        locations(sf_dir),
        CONTEXT,
        state(spark, sf_dir) if needs_state else None,
    )

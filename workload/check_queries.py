"""Checks and comparisons, each straight on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate.functions.formatting import session_time
from dqgate.functions.threshold import rerun_status
from dqgate.operators import kpi, metrics, referential, uniqueness
from dqgate.operators.compare import (
    clean_status,
    compared,
    count_status,
    freshness_status,
    paired,
    with_previous,
)
from dqgate.operators.metrics import Metric, hours_since, table_metrics
from dqgate.plans.run import union_all
from dqgate.sources.files import register_view
from workload import demo
from workload.expected import HOURS, change_status, with_views
from workload.registry import plain, query

_COUNTED = demo.TABLES[:8]
_COUNTS_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in [*_COUNTED, "region_empty"]
)


# ---- aggregates ------------------------------------------------------------


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo.register(spark, sf_dir)
    return metrics.row_counts({t: spark.table(t) for t in [*_COUNTED, "region_empty"]})


@query("row_counts", with_views(_COUNTS_SQL))
def row_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(
    "check_row_count",
    with_views(
        "SELECT table_name, row_count, CASE WHEN row_count = 0 THEN 'Fail' ELSE 'Pass' END AS status "
        f"FROM ({_COUNTS_SQL})"
    ),
)
def check_row_count(spark, sf_dir):
    return _counts(spark, sf_dir).withColumn("status", count_status("row_count"))


_NULL_COLUMNS = ("o_custkey", "o_orderstatus", "o_orderkey")


def _violations(spark, sf_dir, wanted: list[Metric], view: str = "dirty_orders") -> DataFrame:
    frames = table_metrics(demo.view(spark, sf_dir, view), wanted)
    names = F.create_map(*[F.lit(v) for m in wanted for v in (m.check_id, m.column)])
    return union_all(frames).select(
        names[F.col("check_id")].alias("column_name"),
        "total_rows",
        "unexpected_rows",
        clean_status("unexpected_rows").alias("status"),
    )


def _violations_sql(column: str, condition: str) -> str:
    bad = f"count(*) FILTER (WHERE {condition})"
    return (
        f"SELECT '{column}' AS column_name, count(*) AS total_rows, {bad} AS unexpected_rows, "
        f"CASE WHEN {bad} = 0 THEN 'Pass' ELSE 'Fail' END AS status FROM dirty_orders"
    )


@query("check_null", with_views(_violations_sql("o_custkey", "o_custkey IS NULL")))
def check_null(spark, sf_dir):
    return _violations(spark, sf_dir, [Metric(0, "nulls", "o_custkey")])


@query(
    "check_null_multi",
    with_views(" UNION ALL ".join(_violations_sql(c, f"{c} IS NULL") for c in _NULL_COLUMNS)),
)
def check_null_multi(spark, sf_dir):
    return _violations(
        spark, sf_dir, [Metric(i, "nulls", c) for i, c in enumerate(_NULL_COLUMNS)]
    )


@query(
    "check_unexpected",
    with_views(
        _violations_sql("o_orderstatus", "o_orderstatus IN ('X', 'Z')")
        + " UNION ALL "
        + _violations_sql("o_orderpriority", "o_orderpriority IN ('9-NONE')")
        + " UNION ALL "
        + _violations_sql("o_custkey", "o_custkey IN (-1)")
    ),
)
def check_unexpected(spark, sf_dir):
    return _violations(
        spark,
        sf_dir,
        [
            Metric(0, "in_list", "o_orderstatus", ("X", "Z")),
            Metric(1, "in_list", "o_orderpriority", ("9-NONE",)),
            # a text that is no number cannot occur in a numeric column
            Metric(2, "in_list", "o_custkey", ("-1", "n/a")),
        ],
    )


# ---- keys ------------------------------------------------------------------


def _unique(spark, sf_dir, table: str, keys: list[str]) -> DataFrame:
    stats = uniqueness.uniqueness_stats(demo.table(spark, sf_dir, table), keys)
    return stats.select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("column_name"),
        "unexpected_rows",
        "unexpected_keys",
        clean_status("unexpected_rows").alias("status"),
    )


def _unique_sql(table: str, keys: list[str]) -> str:
    some = " OR ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS column_name, "
        "CAST(coalesce(sum(n), 0) AS BIGINT) AS unexpected_rows, count(*) AS unexpected_keys, "
        "CASE WHEN count(*) = 0 THEN 'Pass' ELSE 'Fail' END AS status "
        f"FROM (SELECT count(*) AS n FROM {table} WHERE {some} GROUP BY {', '.join(keys)} "
        "HAVING count(*) > 1)"
    )


@query(
    "check_unique",
    _unique_sql("orders", ["o_orderkey"])
    + " UNION ALL " + _unique_sql("documents", ["text"])
    + " UNION ALL " + _unique_sql("lineitem", ["l_shipdate"]),
)
def check_unique(spark, sf_dir):
    return union_all(
        [
            _unique(spark, sf_dir, "orders", ["o_orderkey"]),
            _unique(spark, sf_dir, "documents", ["text"]),
            _unique(spark, sf_dir, "lineitem", ["l_shipdate"]),
        ]
    )


@query(
    "check_unique_compound",
    _unique_sql("lineitem", ["l_orderkey", "l_linenumber"])
    + " UNION ALL " + _unique_sql("events", ["user_id", "event_type", "ts"])
    + " UNION ALL " + _unique_sql("conversations", ["conv_id", "turn"]),
)
def check_unique_compound(spark, sf_dir):
    return union_all(
        [
            _unique(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"]),
            _unique(spark, sf_dir, "events", ["user_id", "event_type", "ts"]),
            _unique(spark, sf_dir, "conversations", ["conv_id", "turn"]),
        ]
    )


@query(
    "repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def repeated_keys(spark, sf_dir):
    return uniqueness.repeated_keys(
        demo.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


_ORPHAN = "NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dk} = f.{fk})"


def _fk_sql(fact: str, fk: str, dim: str, dk: str) -> str:
    return (
        f"SELECT '{fact}' AS fact, '{dim}' AS dimension, count(*) AS unexpected_rows, "
        f"count(DISTINCT f.{fk}) AS unexpected_keys, "
        "CASE WHEN count(*) = 0 THEN 'Pass' ELSE 'Fail' END AS status "
        f"FROM {fact} f WHERE f.{fk} IS NOT NULL AND {_ORPHAN.format(dim=dim, dk=dk, fk=fk)}"
    )


_FK_PAIRS = (
    ("dirty_orders", "o_custkey", "customer", "c_custkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part_cur", "p_partkey"),
)


@query("check_foreign_key", with_views(" UNION ALL ".join(_fk_sql(*p) for p in _FK_PAIRS)))
def check_foreign_key(spark, sf_dir):
    demo.register(spark, sf_dir)
    checked = []
    for fact, fact_key, dim, dim_key in _FK_PAIRS:
        stats = referential.foreign_key_stats(spark.table(fact), fact_key, spark.table(dim), dim_key)
        checked.append(
            stats.select(
                F.lit(fact).alias("fact"),
                F.lit(dim).alias("dimension"),
                "unexpected_rows",
                "unexpected_keys",
                clean_status("unexpected_rows").alias("status"),
            )
        )
    return union_all(checked)


@query(
    "missing_keys",
    with_views(
        "SELECT f.l_partkey AS missing_key, count(*) AS n_rows FROM lineitem f "
        "WHERE f.l_partkey IS NOT NULL AND "
        f"{_ORPHAN.format(dim='part_cur', dk='p_partkey', fk='l_partkey')} GROUP BY f.l_partkey"
    ),
)
def missing_keys(spark, sf_dir):
    demo.register(spark, sf_dir)
    return referential.missing_keys(
        spark.table("lineitem"), "l_partkey", spark.table("part_cur"), "p_partkey"
    )


_FK_ROW_COLUMNS = "o_orderkey, o_custkey, o_orderstatus"


@query(
    "fk_orphans",
    with_views(
        f"SELECT {_FK_ROW_COLUMNS} FROM dirty_orders f WHERE f.o_custkey IS NOT NULL AND "
        + _ORPHAN.format(dim="customer", dk="c_custkey", fk="o_custkey")
    ),
)
def fk_orphans(spark, sf_dir):
    facts = demo.view(spark, sf_dir, "dirty_orders").select(*_FK_ROW_COLUMNS.split(", "))
    return referential.orphan_rows(facts, "o_custkey", spark.table("customer"), "c_custkey")


@query(
    "fk_valid_rows",
    with_views(
        f"SELECT {_FK_ROW_COLUMNS} FROM dirty_orders f WHERE EXISTS "
        "(SELECT 1 FROM customer d WHERE d.c_custkey = f.o_custkey)"
    ),
)
def fk_valid_rows(spark, sf_dir):
    facts = demo.view(spark, sf_dir, "dirty_orders").select(*_FK_ROW_COLUMNS.split(", "))
    return referential.valid_rows(facts, "o_custkey", spark.table("customer"), "c_custkey")


# ---- freshness -------------------------------------------------------------


@query("freshness", "SELECT event_type, max(ts) AS latest FROM events GROUP BY event_type")
def freshness(spark, sf_dir):
    events = demo.table(spark, sf_dir, "events")
    return events.groupBy("event_type").agg(F.max("ts").alias("latest"))


@query(
    "check_sla",
    " UNION ALL ".join(
        f"SELECT 'ts' AS column_name, CAST({t} AS DOUBLE) AS sla_threshold, {HOURS} AS hours, "
        f"CASE WHEN {HOURS} < {t} THEN 'Pass' ELSE 'Fail' END AS status"
        for t in (24, 6)
    ),
)
def check_sla(spark, sf_dir):
    (latest,) = table_metrics(demo.table(spark, sf_dir, "events"), [Metric(0, "latest", "ts")])
    hours = hours_since(F.col("as_of_max"), session_time(demo.AS_OF))
    return latest.select(
        F.lit("ts").alias("column_name"),
        F.explode(F.array(F.lit(24.0), F.lit(6.0))).alias("sla_threshold"),
        hours.alias("hours"),
    ).withColumn("status", freshness_status("hours", "sla_threshold"))


# ---- thresholds and comparisons -------------------------------------------


def _pct_sql(previous: str, current: str) -> str:
    return f"trunc(({current} - {previous})::DOUBLE / nullif({previous}, 0) * 100)"


@query(
    "threshold_rule",
    f"""SELECT l_suppkey, previous_rows, current_rows,
               CAST({_pct_sql('previous_rows', 'current_rows')} AS BIGINT) AS pct_change,
               {change_status('previous_rows', 'current_rows', _pct_sql('previous_rows', 'current_rows'), False)} AS status,
               {change_status('previous_rows', 'current_rows', _pct_sql('previous_rows', 'current_rows'), True)} AS rerun_status
        FROM (SELECT l_suppkey,
                     count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1995-06-17 00:00:00') AS previous_rows,
                     count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1995-06-17 00:00:00') AS current_rows
              FROM lineitem GROUP BY l_suppkey)""",
)
def threshold_rule(spark, sf_dir):
    before = F.col("l_shipdate") < F.lit("1995-06-17 00:00:00").cast("timestamp_ntz")
    per_supplier = (
        demo.table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count_if(before).alias("previous_rows"),
            F.count_if(~before).alias("current_rows"),
        )
    )
    judged = compared(per_supplier, "previous_rows", "current_rows", "pair")
    return judged.withColumn(
        "rerun_status", rerun_status("previous_rows", "current_rows")
    )


_SRC_DEST = (
    ("orders_prev", "orders"),
    ("lineitem_prev", "lineitem"),
    ("customer", "customer"),
    ("part", "part_cur"),
    ("region_empty", "region_empty"),
    ("region_empty", "region"),
)


@query(
    "src_dest_rowcount",
    with_views(
        "SELECT *, "
        f"CAST({_pct_sql('source_result', 'destination_result')} AS BIGINT) AS pct_change, "
        + change_status(
            "source_result", "destination_result", _pct_sql("source_result", "destination_result"), False
        )
        + " AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{s}->{d}' AS check_key, (SELECT count(*) FROM {s}) AS source_result, "
            f"(SELECT count(*) FROM {d}) AS destination_result"
            for s, d in _SRC_DEST
        )
        + ")"
    ),
)
def src_dest_rowcount(spark, sf_dir):
    demo.register(spark, sf_dir)

    def counts(side: int) -> DataFrame:
        return metrics.row_counts(
            {f"{p[0]}->{p[1]}": spark.table(p[side]) for p in _SRC_DEST}
        ).withColumnRenamed("table_name", "check_key")

    both = paired(counts(0), counts(1), "check_key", "row_count")
    return compared(both, "source_result", "destination_result", "pair")


@query(
    "prev_state_lookup",
    with_views(
        "SELECT c.state_key, p.result AS previous_rows, c.current_rows FROM "
        "(SELECT CAST(o_custkey AS VARCHAR) AS state_key, count(*) AS current_rows "
        " FROM orders GROUP BY o_custkey) c LEFT JOIN "
        "(SELECT CAST(o_custkey AS VARCHAR) AS state_key, count(*) AS result "
        " FROM orders_prev WHERE o_orderstatus <> 'P' AND o_totalprice > 300000 GROUP BY o_custkey) p USING (state_key)"
    ),
)
def prev_state_lookup(spark, sf_dir):
    """Stored result per customer next to the current one; some have none stored."""
    demo.register(spark, sf_dir)

    def per_customer(orders: DataFrame, alias: str) -> DataFrame:
        return orders.groupBy(F.col("o_custkey").cast("string").alias("state_key")).agg(
            F.count(F.lit(1)).alias(alias)
        )

    stored = per_customer(spark.table("orders_prev").where("o_orderstatus <> 'P' AND o_totalprice > 300000"), "result")
    current = per_customer(spark.table("orders"), "current_rows")
    return with_previous(current, stored, ["state_key"], "result", "previous_rows").select(
        "state_key", "previous_rows", "current_rows"
    )


# ---- views and KPIs --------------------------------------------------------


@query(
    "view_sql",
    "SELECT o_orderpriority, count(*) AS n_orders, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue "
    "FROM orders GROUP BY o_orderpriority",
)
def view_sql(spark, sf_dir):
    demo.register(spark, sf_dir)
    register_view(demo.table(spark, sf_dir, "orders"), "viewed_orders")
    return plain(
        spark.sql(
            "SELECT o_orderpriority, count(*) AS n_orders, "
            "sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM viewed_orders GROUP BY o_orderpriority"
        )
    )


@query(
    "kpi_sql",
    "SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders",
)
def kpi_sql(spark, sf_dir):
    demo.register(spark, sf_dir)
    return plain(kpi.kpi_sql(spark, demo.PRICE_QUERY).select("value"))


_AGGREGATES = (
    ("sum", "o_custkey", "sum(o_custkey)"),
    ("count", "o_orderstatus", "count(o_orderstatus)"),
    ("min", "o_totalprice", "min(o_totalprice)"),
    ("max", "o_totalprice", "max(o_totalprice)"),
    ("count_distinct", "o_custkey", "count(DISTINCT o_custkey)"),
    ("median", "o_custkey", "median(o_custkey)"),
    ("sum", "o_custkey * 2", "sum(o_custkey * 2)"),
    ("sum", "DISTINCT o_custkey", "sum(DISTINCT o_custkey)"),
    ("var_pop", "o_custkey % 7", "round(var_pop(o_custkey % 7), 9)"),
)


@query(
    "kpi_agg",
    " UNION ALL ".join(
        f"SELECT '{f}' AS agg_function, '{c}' AS column_name, CAST({sql} AS DOUBLE) AS value "
        "FROM orders"
        for f, c, sql in _AGGREGATES
    ),
)
def kpi_agg(spark, sf_dir):
    wanted = [
        Metric(i, "aggregate", column, function=function)
        for i, (function, column, _) in enumerate(_AGGREGATES)
    ]
    name = F.create_map(*[F.lit(v) for m in wanted for v in (m.check_id, m.function)])
    column = F.create_map(*[F.lit(v) for m in wanted for v in (m.check_id, m.column)])
    measured = union_all(table_metrics(demo.table(spark, sf_dir, "orders"), wanted))
    return plain(
        measured.select(
            name[F.col("check_id")].alias("agg_function"),
            column[F.col("check_id")].alias("column_name"),
            F.round("value", 9).alias("value"),
        )
    )

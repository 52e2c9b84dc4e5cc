"""Sources and sinks: scans, incremental pulls, upserts and the warehouse."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.operators.kpi import kpi_warehouse
from dqgate.session import scratch_dir
from dqgate.sinks import jdbc as warehouse_sink
from dqgate.operators.metrics import Metric
from dqgate.sinks import layers
from dqgate.sinks.key_store import kept_uniqueness_stats, refresh_keys
from dqgate.sinks.observed import overwrite_observed
from dqgate.sources import incremental, jdbc
from dqgate.sources.files import read_path, read_table
from dqgate.sources.locations import load_table
from dqgate.streaming.incremental import append_available, stream_path
from dqgate.streaming.upserts import upsert_available
from workload import demo
from workload.registry import plain, query


@query("scan_path", "SELECT * FROM orders")
def scan_path(spark, sf_dir):
    return read_path(spark, f"{sf_dir}/orders.parquet")


@query("scan_table", "SELECT * FROM part")
def scan_table(spark, sf_dir):
    demo.register(spark, sf_dir)
    return read_table(spark, "part")


@query(
    "load_by_location",
    "SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer UNION ALL "
    "SELECT 'supplier', s_suppkey, s_name FROM supplier",
)
def load_by_location(spark, sf_dir):
    demo.register(spark, sf_dir)
    places = demo.locations(sf_dir)
    customer = load_table(spark, n.LOCATION_PATH, "customer.parquet", places, n.SILVER)
    supplier = load_table(spark, n.LOCATION_CATALOG, "supplier", places)
    return customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    ).unionByName(
        supplier.select(
            F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
        )
    )


# ---- incremental pull ------------------------------------------------------


@query("incremental_pull", "SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_pull(spark, sf_dir):
    events = demo.table(spark, sf_dir, "events")
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return incremental.rows_after(events, "ts", mark).select("event_id", "ts", "user_id")


@query(
    "incremental_load",
    "SELECT event_id, ts, user_id, value FROM events",
)
def incremental_load(spark, sf_dir):
    """A target that holds January's first half catches up with the source."""
    events = demo.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    location = scratch_dir(spark, "events")
    layers.overwrite(events.where("ts <= timestamp_ntz '2024-01-15 00:00:00'"), location)
    new = incremental.pull_new_rows(events, read_path(spark, location), "ts")
    layers.append(new, location)
    return read_path(spark, location)


@query(
    "incremental_stream",
    "SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
)
def incremental_stream(spark, sf_dir):
    """The same pull as a stream; the second call finds nothing new."""
    schema = demo.table(spark, sf_dir, "events").schema
    arriving = stream_path(spark, sf_dir, schema, pathGlobFilter="events.parquet")
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    rows = incremental.rows_after(arriving, "ts", mark).select("event_id", "ts", "user_id")
    location, checkpoint = scratch_dir(spark, "events"), scratch_dir(spark, "progress")
    for _ in range(2):
        append_available(rows, location, checkpoint).awaitTermination()
    return read_path(spark, location)


# ---- layer sinks -----------------------------------------------------------


@query("sink_overwrite", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_overwrite(spark, sf_dir):
    """The second write replaces rows and columns of the first."""
    customer = demo.table(spark, sf_dir, "customer")
    location = scratch_dir(spark, "customer")
    layers.overwrite(customer.select("c_custkey", "c_acctbal"), location)
    layers.overwrite(customer.select("c_custkey", "c_name", "c_mktsegment"), location)
    return read_path(spark, location)


@query("sink_append", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def sink_append(spark, sf_dir):
    location = scratch_dir(spark, "parties")
    layers.overwrite(demo.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), location)
    more = demo.table(spark, sf_dir, "customer")
    layers.append(more.select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name")), location)
    return read_path(spark, location)


# Changes to `customer`: those of one segment get a new name and segment, and for
# each of another a new customer appears under a negative key.
_CHANGES = """
SELECT c_custkey, concat(c_name, ' new') AS c_name, 'CHANGED' AS c_mktsegment
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT -1 - c_custkey, concat('added ', c_name), 'ADDED' FROM customer WHERE c_mktsegment = 'MACHINERY'"""

_UPSERTED = f"""
WITH changes AS ({_CHANGES})
SELECT c.c_custkey, coalesce(u.c_name, c.c_name) AS c_name, c.c_nationkey, c.c_acctbal,
       coalesce(u.c_mktsegment, c.c_mktsegment) AS c_mktsegment
FROM customer c LEFT JOIN changes u USING (c_custkey)
UNION ALL
SELECT c_custkey, c_name, NULL, NULL, c_mktsegment FROM changes
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = changes.c_custkey)"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo.register(spark, sf_dir)
    return spark.sql(_CHANGES)


@query("upsert_layer", _UPSERTED)
def upsert_layer(spark, sf_dir):
    """Columns the changes lack keep their value; an equal second upsert changes nothing."""
    location = scratch_dir(spark, "customer")
    changes = _changes(spark, sf_dir)
    layers.overwrite(demo.table(spark, sf_dir, "customer"), location)
    layers.upsert(spark, changes, location, ["c_custkey"])
    layers.upsert(spark, changes, location, ["c_custkey"])
    return read_path(spark, location)


@query("upsert_shuffled", _UPSERTED)
def upsert_shuffled(spark, sf_dir):
    """The same merge as it is planned when the changes are too large to broadcast."""
    return layers.merged(
        demo.table(spark, sf_dir, "customer"), _changes(spark, sf_dir), ["c_custkey"]
    )


@query(
    "upsert_partitioned",
    """WITH changes AS (SELECT l_returnflag, l_suppkey, 0 AS n_lines FROM lineitem
                        WHERE l_returnflag = 'R' GROUP BY ALL)
       SELECT t.l_returnflag, t.l_suppkey, coalesce(u.n_lines, t.n_lines) AS n_lines
       FROM (SELECT l_returnflag, l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY ALL) t
       LEFT JOIN changes u USING (l_returnflag, l_suppkey)""",
)
def upsert_partitioned(spark, sf_dir):
    """Only the partition that the changes touch is read and rewritten."""
    lines = demo.table(spark, sf_dir, "lineitem")
    counted = lines.groupBy("l_returnflag", "l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
    location = scratch_dir(spark, "lines")
    layers.overwrite(counted, location, partition_by=["l_returnflag"])
    changes = (
        lines.where("l_returnflag = 'R'")
        .select("l_returnflag", "l_suppkey", F.lit(0).cast("bigint").alias("n_lines"))
        .distinct()
    )
    layers.upsert(
        spark, changes, location, ["l_returnflag", "l_suppkey"], partition_by=["l_returnflag"]
    )
    return read_path(spark, location)


@query(
    "upsert_files",
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 < 20 THEN 'changed' ELSE o_orderstatus END AS o_orderstatus "
    "FROM orders UNION ALL SELECT -1 - o_orderkey, o_custkey, 'added' FROM orders WHERE o_orderkey % 1000 < 10",
)
def upsert_files(spark, sf_dir):
    """The orders lie in files by the end of their key, so the changes concern few of them: the others stay."""
    orders = demo.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    end = F.col("o_orderkey") % 1000
    location = scratch_dir(spark, "orders")
    layers.overwrite(orders.repartitionByRange(16, end), location)
    changed = orders.where(end < 20).withColumn("o_orderstatus", F.lit("changed"))
    added = orders.where(end < 10).select((-1 - F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", F.lit("added").alias("o_orderstatus"))
    layers.upsert(spark, changed.unionByName(added), location, ["o_orderkey"])
    return read_path(spark, location)


@query(
    "write_measured",
    "SELECT 0 AS check_id, count(*) AS total_rows, NULL::BIGINT AS unexpected_rows, NULL::TIMESTAMP AS as_of_max FROM events "
    "UNION ALL SELECT 1, count(*), count(*) FILTER (value IS NULL), NULL FROM events "
    "UNION ALL SELECT 2, count(*), count(*) FILTER (event_type IN ('click', 'view')), NULL FROM events "
    "UNION ALL SELECT 3, count(*), NULL, max(ts) FROM events",
)
def write_measured(spark, sf_dir):
    """A table's row count, nulls, unexpected values and latest time, taken while it is written."""
    metrics = [
        Metric(0, "rows"),
        Metric(1, "nulls", "value"),
        Metric(2, "in_list", "event_type", ("click", "view")),
        Metric(3, "latest", "ts"),
    ]
    found = overwrite_observed(demo.table(spark, sf_dir, "events"), scratch_dir(spark, "events"), metrics, partition_by=["event_type"])
    return plain(found.select("check_id", "total_rows", "unexpected_rows", F.col("as_of_max").cast("timestamp_ntz").alias("as_of_max")))


def _kept_sql(run: int, condition: str, folders: int) -> str:
    return (
        f"SELECT {run} AS run, {folders} AS folders_read, CAST(coalesce(sum(n), 0) AS BIGINT) AS unexpected_rows, count(*) AS unexpected_keys "
        f"FROM (SELECT count(*) AS n FROM lineitem WHERE {condition} GROUP BY l_suppkey, l_shipdate HAVING count(*) > 1)"
    )


@query("unique_kept_counts", _kept_sql(1, "l_returnflag <> 'R'", 2) + " UNION ALL " + _kept_sql(2, "true", 1))
def unique_kept_counts(spark, sf_dir):
    """A table gains a folder between two runs; the second reads this one only and finds its repeats in all."""
    lines = demo.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_returnflag")
    location, store = scratch_dir(spark, "lines"), scratch_dir(spark, "keys")
    keys, found = ["l_suppkey", "l_shipdate"], []
    for run, part in enumerate(["l_returnflag <> 'R'", "l_returnflag = 'R'"], 1):
        layers.append(lines.where(part), location, partition_by=["l_returnflag"])
        folders = refresh_keys(spark, location, keys, store)
        stats = kept_uniqueness_stats(spark, location, keys, store)
        measured = scratch_dir(spark, "stats")
        layers.overwrite(stats.select(F.lit(run).alias("run"), F.lit(len(folders)).alias("folders_read"), "*"), measured)
        found.append(read_path(spark, measured))
    return found[0].unionByName(found[1])


@query(
    "incremental_upsert_stream",
    "SELECT event_id, ts, user_id, CASE WHEN ts > TIMESTAMP '2024-01-10 00:00:00' THEN value END AS value FROM events",
)
def incremental_upsert_stream(spark, sf_dir):
    """A target whose values are lost catches up from a stream; the second call finds nothing new."""
    events = demo.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    location, checkpoint = scratch_dir(spark, "events"), scratch_dir(spark, "progress")
    old = events.where("ts <= timestamp_ntz '2024-01-15 00:00:00'")
    layers.overwrite(old.withColumn("value", F.lit(None).cast(events.schema["value"].dataType)), location)
    schema = demo.table(spark, sf_dir, "events").schema
    arriving = stream_path(spark, sf_dir, schema, pathGlobFilter="events.parquet").select(*events.columns)
    new = arriving.where("ts > timestamp_ntz '2024-01-10 00:00:00'")
    for _ in range(2):
        upsert_available(new, location, checkpoint, ["event_id"], "ts").awaitTermination()
    return read_path(spark, location)


# ---- warehouse -------------------------------------------------------------
#
# The warehouse is an embedded in-memory database that only the Spark process
# itself sees: no server, no port. On a cluster these queries need a real one.

WAREHOUSE = jdbc.Warehouse(
    "jdbc:derby:memory:dqgate;create=true", driver="org.apache.derby.jdbc.EmbeddedDriver"
)


def _new_table() -> str:
    return f"CUSTOMER_{uuid.uuid4().hex[:12].upper()}"


def _stored_customer(spark: SparkSession, sf_dir: str) -> str:
    name = _new_table()
    warehouse_sink.overwrite_table(demo.table(spark, sf_dir, "customer"), WAREHOUSE, name)
    return name


@query("scan_jdbc", "SELECT * FROM customer")
def scan_jdbc(spark, sf_dir):
    """Read back by four tasks over ranges of the key."""
    name = _stored_customer(spark, sf_dir)
    return jdbc.read_warehouse(spark, WAREHOUSE, name, '"c_custkey"', num_partitions=4)


@query("jdbc_overwrite", "SELECT c_custkey, c_name FROM customer")
def jdbc_overwrite(spark, sf_dir):
    """The second write replaces rows and columns of the first."""
    name = _stored_customer(spark, sf_dir)
    narrow = demo.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    warehouse_sink.overwrite_table(narrow, WAREHOUSE, name)
    return jdbc.read_warehouse(spark, WAREHOUSE, name)


@query("jdbc_append", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def jdbc_append(spark, sf_dir):
    name = _stored_customer(spark, sf_dir)
    warehouse_sink.append_table(demo.table(spark, sf_dir, "customer"), WAREHOUSE, name)
    return jdbc.read_warehouse(spark, WAREHOUSE, name)


@query("jdbc_truncate_load", "SELECT * FROM customer")
def jdbc_truncate_load(spark, sf_dir):
    """A table loaded twice over holds each row once after a truncating load."""
    customer = demo.table(spark, sf_dir, "customer")
    name = _stored_customer(spark, sf_dir)
    warehouse_sink.append_table(customer, WAREHOUSE, name)
    warehouse_sink.truncate_load_table(customer, WAREHOUSE, name)
    return jdbc.read_warehouse(spark, WAREHOUSE, name)


@query("kpi_jdbc_pushdown", "SELECT CAST(sum(c_nationkey) AS DOUBLE) AS value FROM customer")
def kpi_jdbc_pushdown(spark, sf_dir):
    name = _stored_customer(spark, sf_dir)
    query_text = f'SELECT SUM(CAST("c_nationkey" AS BIGINT)) AS TOTAL FROM {name}'
    return plain(kpi_warehouse(spark, WAREHOUSE, query_text).select("value"))


@query(
    "upsert_keeps_layout",
    "SELECT o_orderstatus, 'o_orderstatus' AS layout, count(*) AS n_rows, "
    "count(*) FILTER (WHERE o_orderkey % 3 = 0) AS n_changed FROM orders GROUP BY o_orderstatus",
)
def upsert_keeps_layout(spark, sf_dir):
    """An upsert by a key outside the partition columns leaves the table partitioned as it was."""
    orders = demo.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit(0).alias("version"))
    location = scratch_dir(spark, "layout")
    layers.overwrite(orders, location, partition_by=["o_orderstatus"])
    changes = orders.where("o_orderkey % 3 = 0").withColumn("version", F.lit(1))
    layers.upsert(spark, changes, location, ["o_orderkey"])
    layout = ",".join(layers.partition_columns(spark, location))
    return spark.read.parquet(location).groupBy("o_orderstatus").agg(
        F.lit(layout).alias("layout"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("version") == 1).alias("n_changed"),
    )

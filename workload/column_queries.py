"""Column helpers and text forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqgate.functions import columns, formatting
from workload import demo
from workload.registry import plain, query


@query("distinct_values", "SELECT DISTINCT o_orderstatus FROM orders")
def distinct_values(spark, sf_dir):
    return columns.distinct_values(demo.table(spark, sf_dir, "orders"), "o_orderstatus")


@query("first_value", "SELECT arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders")
def first_value(spark, sf_dir):
    return columns.first_value(demo.table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey")


@query(
    "column_list",
    "SELECT o_orderpriority AS position, CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY o_orderpriority",
)
def column_list(spark, sf_dir):
    """Orders per priority, as a list in the order of the priorities."""
    counted = demo.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).cast("string").alias("n_orders")
    )
    return columns.column_list(counted, "n_orders", "o_orderpriority")


@query(
    "normalize_columns",
    'SELECT p_partkey AS part_key, p_name AS a_b_c, p_brand AS na_ve_col, '
    'p_retailprice AS "price_($)", p_size AS "size-mm" FROM part',
)
def normalize_columns(spark, sf_dir):
    part = demo.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(" Part Key "),
        F.col("p_name").alias("A  B|C"),
        F.col("p_brand").alias("naïve col"),
        F.col("p_retailprice").alias("Price ($)"),
        F.col("p_size").alias("Size-MM"),
    )
    return columns.normalize_columns(part)


@query(
    "normalize_names",
    "SELECT doc_id, regexp_replace(regexp_replace(lower(source || ' | ' || lang), "
    "'[^0-9a-z]+', '_', 'g'), '^_|_$', '', 'g') AS name FROM documents",
)
def normalize_names(spark, sf_dir):
    """Names held in a column, such as those of a schema table."""
    named = F.regexp_replace(F.concat_ws(" | ", "source", "lang"), "[^0-9A-Za-z| ]", " ")
    documents = demo.table(spark, sf_dir, "documents")
    return documents.select("doc_id", columns.normalize_name_text(named).alias("name"))


_FRONT_REST = sorted(
    ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
     "l_returnflag", "l_linestatus", "l_shipdate")
)


@query("cols_to_front", f"SELECT l_linenumber, l_orderkey, {', '.join(_FRONT_REST)} FROM lineitem")
def cols_to_front(spark, sf_dir):
    return columns.cols_to_front(
        demo.table(spark, sf_dir, "lineitem"), ["l_linenumber", "l_orderkey"]
    )


@query(
    "fmt_thousands",
    "SELECT o_orderkey, format('{:,}', o_orderkey * 12345) AS shown, "
    "CAST(o_orderkey * 12345 AS DOUBLE) AS plain, "
    "format('{:,}', CAST(trunc(price) AS BIGINT)) || CASE WHEN regexp_extract(CAST(price AS VARCHAR), "
    "'\\.(\\d*?)0*$', 1) = '' THEN '' ELSE '.' || regexp_extract(CAST(price AS VARCHAR), "
    "'\\.(\\d*?)0*$', 1) END AS price_text "
    "FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38,6)) AS price FROM orders)",
)
def fmt_thousands(spark, sf_dir):
    shown = formatting.thousands(F.col("o_orderkey") * 12345)
    price = F.col("o_totalprice").cast("decimal(38,6)")
    return plain(
        demo.table(spark, sf_dir, "orders").select(
            "o_orderkey",
            shown.alias("shown"),
            formatting.plain_number(shown).alias("plain"),
            formatting.number_text(price).alias("price_text"),
        )
    )


@query("fmt_timestamp", "SELECT event_id, strftime(ts, '%m-%d-%Y %H:%M') AS validated_on FROM events")
def fmt_timestamp(spark, sf_dir):
    return demo.table(spark, sf_dir, "events").select(
        "event_id", formatting.validated_on(F.col("ts")).alias("validated_on")
    )


@query(
    "fmt_list",
    "SELECT p_partkey, '''' || p_brand || ''', ''' || p_type || ''', \"it''s ' || p_size || '\"' AS listed "
    "FROM part",
)
def fmt_list(spark, sf_dir):
    items = F.array("p_brand", "p_type", F.concat(F.lit("it's "), "p_size"))
    return demo.table(spark, sf_dir, "part").select(
        "p_partkey", formatting.list_text(items).alias("listed")
    )


@query(
    "fmt_heading",
    "SELECT event_type, replace(event_type || '_' || user_id, '_', ' ') AS heading, event_id FROM events",
)
def fmt_heading(spark, sf_dir):
    name = F.concat_ws("_", "event_type", "user_id")
    return demo.table(spark, sf_dir, "events").select(
        "event_type", formatting.heading_text(name).alias("heading"), "event_id"
    )

"""SQL that states the expected long result of the demonstration.

Every check is written out as a row of plain SQL over the given tables, apart
from the code that plans the checks.
"""

from __future__ import annotations

from workload.demo import BUYERS_QUERY, PART_QUERY, PRICE_QUERY, VIEWS

VIEW_CTES = ",\n".join(f"{name} AS ({sql})" for name, sql in VIEWS.items())

_COLUMNS = {
    "stage": "VARCHAR",
    "family": "VARCHAR",
    "category": "VARCHAR",
    "check_type": "VARCHAR",
    "layer": "VARCHAR",
    "src_layer": "VARCHAR",
    "table_name": "VARCHAR",
    "src_table": "VARCHAR",
    "dest_table": "VARCHAR",
    "column_name": "VARCHAR",
    "unexpected_value": "VARCHAR",
    "unique_id": "VARCHAR",
    "kpi_name": "VARCHAR",
    "agg_function": "VARCHAR",
    "src_query": "VARCHAR",
    "dest_query": "VARCHAR",
    "total_rows": "BIGINT",
    "unexpected_rows": "BIGINT",
    "unexpected_keys": "BIGINT",
    "previous_result": "DECIMAL(38,12)",
    "current_result": "DECIMAL(38,12)",
    "hours": "DOUBLE",
    "sla": "DOUBLE",
    "on_stage_depend": "INTEGER",
    "broken": "BOOLEAN",
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _count(source: str, condition: str = "true") -> str:
    return f"(SELECT count(*) FROM {source} WHERE {condition})"


def _row(**values: str | int | None) -> str:
    parts = [f"CAST({values.pop(c, 'NULL')} AS {t}) AS {c}" for c, t in _COLUMNS.items()]
    if values:
        raise ValueError(f"unknown columns {sorted(values)}")
    return "SELECT " + ", ".join(parts)


def _named(stage: str, family: str, category: str, check: str, **values) -> str:
    return _row(
        stage=_text(stage), family=_text(family), category=_text(category),
        check_type=_text(check), **{"on_stage_depend": 0, **values},
    )


_B, _S, _G = "Bronze data check", "Silver data check", "Gold data check"
_P, _K = "Pre and post runs rowcount check", "KPI data check"


def _row_count(stage: str, table: str, depend: int = 0) -> str:
    n = _count(table)
    return _named(
        stage, "row_count", "Row Count", "RowCount", table_name=_text(table), total_rows=n,
        current_result=n, on_stage_depend=depend,
    )


def _source_destination(source: str, target: str, depend: int = 0) -> str:
    return _named(
        _B, "row_count", "Source Destination Row Count", "SourceDestinationRowcountResult",
        src_table=_text(source), dest_table=_text(target), total_rows=_count(target),
        previous_result=_count(source), current_result=_count(target), on_stage_depend=depend,
    )


def _quality(stage: str, category: str, check: str, table: str, column: str, **values) -> str:
    return _named(
        stage, "data_quality", category, check, table_name=_text(table), column_name=_text(column),
        total_rows=_count(table), **values,
    )


def _null(stage: str, table: str, column: str, depend: int) -> str:
    bad = _count(table, f"{column} IS NULL")
    return _quality(
        stage, "Null Column Validation", "NullCheck", table, column, unexpected_rows=bad,
        on_stage_depend=depend,
    )


def _unexpected(column: str, values: list[str]) -> str:
    listed = ", ".join(_text(v) for v in values)
    return _quality(
        _B, "Unexpected list Validation", "UnExpectedList", "dirty_orders", column,
        unexpected_value=_text(listed),
        unexpected_rows=_count("dirty_orders", f"{column} IN ({listed})"),
    )


def _unique(stage: str, table: str, keys: list[str], depend: int) -> str:
    per_key = f"(SELECT count(*) AS n FROM {table} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
    shown = keys[0] if len(keys) == 1 else ", ".join(_text(k) for k in keys)
    return _quality(
        stage, "Duplicates Validation", "UniqueCheck", table, shown,
        unexpected_rows=f"(SELECT coalesce(sum(n), 0) FROM {per_key})",
        unexpected_keys=f"(SELECT count(*) FROM {per_key})", on_stage_depend=depend,
    )


def _foreign_key(fact: str, fact_key: str, dim: str, dim_key: str, depend: int) -> str:
    missing = (
        f"{fact_key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} = f.{fact_key})"
    )
    return _quality(
        _B, "Foreign Key Validation", "ForeignKeyCheck", fact, fact_key, src_table=_text(fact),
        dest_table=_text(dim), unexpected_rows=_count(f"{fact} f", missing),
        unexpected_keys=f"(SELECT count(DISTINCT {fact_key}) FROM {fact} f WHERE {missing})",
        on_stage_depend=depend,
    )


HOURS = (
    "(SELECT (epoch_us(TIMESTAMP '2024-01-31 06:00:00') - epoch_us(max(ts))) / 3.6e9 FROM events)"
)


def _sla(threshold: int, depend: int) -> str:
    return _quality(
        _B, "SLA Check Validation", "SLACheck", "events", "ts", hours=HOURS, sla=threshold,
        on_stage_depend=depend,
    )


def _pre_post(layer: str, table: str, previous: str | None, depend: int) -> str:
    return _named(
        _P, "pre_post", "Pre Post Runs", "PrePostRowcountCheck", layer=_text(layer),
        table_name=_text(table), total_rows=_count(table), current_result=_count(table),
        previous_result=_count(previous) if previous else "NULL", on_stage_depend=depend,
    )


def path_query(function: str, column: str, table: str) -> str:
    """Query text of a KPI on a path, with the folder left out."""
    return f"SELECT {function}({column}) AS {function} FROM PARQUET.`{table}.parquet`"


def _kpi(category: str, check: str, uid: str, name: str, function: str, column: str, **values) -> str:
    return _named(
        _K, "kpi", category, check, unique_id=_text(uid), kpi_name=_text(name),
        agg_function=_text(function), column_name=_text(column), **values,
    )


def _scalar(expression: str, source: str) -> str:
    return f"(SELECT {expression} FROM {source})"


_PRICE = "sum(CAST(o_totalprice AS DECIMAL(18,2)))"

ROWS = [
    *[
        _row_count(_B, t, int(t == "orders"))
        for t in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "region_empty",
        )
    ],
    _source_destination("orders_prev", "orders", 1),
    _source_destination("lineitem_prev", "lineitem"),
    _source_destination("customer", "customer"),
    _source_destination("part", "part_cur"),
    _null(_B, "dirty_orders", "o_custkey", 1),
    _null(_B, "dirty_orders", "o_orderstatus", 1),
    _null(_B, "dirty_orders", "o_orderkey", 1),
    _unexpected("o_orderstatus", ["X", "Z"]),
    _unexpected("o_orderpriority", ["9-NONE"]),
    _unique(_B, "lineitem", ["l_orderkey", "l_linenumber"], 1),
    _unique(_B, "orders", ["o_orderkey"], 0),
    _unique(_B, "documents", ["text"], 0),
    _foreign_key("dirty_orders", "o_custkey", "customer", "c_custkey", 1),
    _foreign_key("documents", "doc_id", "labels", "doc_id", 0),
    _sla(24, 0),
    _sla(6, 1),
    _row_count(_S, "customer", 1),
    _null(_S, "customer", "c_custkey", 1),
    _null(_S, "customer", "c_name", 1),
    _named(
        _G, "data_quality", "Null Column Validation", "NullCheck", table_name="'no_such_table'",
        column_name="'id'", on_stage_depend=1, broken="true",
    ),
    _unique(_G, "supplier", ["s_suppkey"], 1),
    _pre_post("Bronze", "orders", "orders_prev", 1),
    _pre_post("Bronze", "lineitem", "lineitem_prev", 1),
    _pre_post("Silver", "customer", "customer", 0),
    _pre_post("Silver", "part_cur", "part", 0),
    _pre_post("Silver", "region", None, 0),
    _pre_post("Silver", "region_empty", None, 0),
    _kpi(
        "Pre-Post Run", "PrePostRowcountCheck", "K1", "Revenue", "SUM", "o_totalprice",
        layer="'Gold'", table_name="'orders'", dest_query=_text(PRICE_QUERY), on_stage_depend=1,
        previous_result=_scalar(_PRICE, "orders_prev"), current_result=_scalar(_PRICE, "orders"),
    ),
    _kpi(
        "Pre-Post Run", "PrePostRowcountCheck", "K2", "Lines", "COUNT", "l_orderkey",
        layer="'Silver'", table_name="'lineitem'", on_stage_depend=1,
        dest_query=_text(path_query("COUNT", "l_orderkey", "lineitem")), total_rows=_count("lineitem"),
        previous_result=_count("lineitem_prev"), current_result=_count("lineitem"),
    ),
    _kpi(
        "Pre-Post Run", "PrePostRowcountCheck", "K3", "Last customer", "MAX", "c_custkey",
        layer="'Silver'", table_name="'customer'", total_rows=_count("customer"),
        dest_query=_text(path_query("MAX", "c_custkey", "customer")),
        current_result=_scalar("max(c_custkey)", "customer"),
    ),
    _kpi(
        "Source Destination", "SourceDestinationRowcountResult", "K4", "Sizes", "SUM", "p_size",
        layer="'Gold'", src_layer="'Silver'", src_table="'part'", dest_table="'part_cur'",
        src_query=_text(path_query("SUM", "p_size", "part")), dest_query=_text(PART_QUERY),
        previous_result=_scalar("sum(p_size)", "part"), current_result=_scalar("sum(p_size)", "part_cur"),
    ),
    _kpi(
        "Source Destination", "SourceDestinationRowcountResult", "K5", "Orders", "COUNT", "o_orderkey",
        layer="'Gold'", src_layer="'Silver'", src_table="'orders'", dest_table="'orders'",
        src_query=_text(path_query("COUNT", "o_orderkey", "orders")), total_rows=_count("orders"),
        dest_query=_text(path_query("COUNT", "o_orderkey", "orders")),
        previous_result=_count("orders"), current_result=_count("orders"),
    ),
    _kpi(
        "KPI", "KPIResultCheck", "K6", "Key sum", "SUM", "o_custkey", layer="'Gold'",
        table_name="'orders'", dest_query=_text(path_query("SUM", "o_custkey", "orders")),
        total_rows=_count("orders"), current_result=_scalar("sum(o_custkey)", "orders"),
    ),
    _kpi(
        "KPI", "KPIResultCheck", "K7", "Buyers", "COUNT", "o_custkey", layer="'Gold'",
        table_name="'orders'", dest_query=_text(BUYERS_QUERY),
        current_result=_scalar("count(DISTINCT o_custkey)", "orders"),
    ),
    _kpi(
        "KPI", "KPIResultCheck", "K8", "Buyers on path", "COUNT_DISTINCT", "o_custkey", layer="'Gold'",
        table_name="'orders'", total_rows=_count("orders"),
        dest_query=_text(path_query("COUNT_DISTINCT", "o_custkey", "orders")),
        current_result=_scalar("count(DISTINCT o_custkey)", "orders"),
    ),
]

_RAW_PCT = (
    "(trunc(current_result) - trunc(previous_result))::DOUBLE"
    " / nullif(trunc(previous_result)::DOUBLE, 0) * 100"
)
_EXACT_PCT = "(current_result - previous_result)::DOUBLE * 100 / nullif(previous_result::DOUBLE, 0)"
_IS_PAIR = "category IN ('Source Destination Row Count', 'Source Destination')"
_IS_RERUN = "category IN ('Pre Post Runs', 'Pre-Post Run')"


def change_status(previous: str, current: str, pct: str, first_run: bool) -> str:
    """The change rule as SQL; `pct` is the truncated percentage."""
    limits = f"CASE WHEN {pct} > 20 OR {pct} < -5 THEN 'Fail' ELSE 'Pass' END"
    if first_run:
        return (
            f"CASE WHEN {current} IS NULL THEN 'Fail' "
            f"WHEN {previous} IS NULL OR {previous} = 0 THEN "
            f"CASE WHEN {current} = 0 THEN 'Fail' ELSE 'Pass' END ELSE {limits} END"
        )
    return (
        f"CASE WHEN {previous} IS NULL OR {current} IS NULL THEN 'Fail' "
        f"WHEN trunc({previous}) = 0 THEN "
        f"CASE WHEN trunc({current}) = 0 THEN 'Pass' ELSE 'Fail' END ELSE {limits} END"
    )


_ALL_ROWS = "\nUNION ALL ".join(ROWS)
RESULT_CTES = f"""{VIEW_CTES},
raw AS ({_ALL_ROWS}),
changed AS (SELECT *, trunc(CASE WHEN {_IS_RERUN} THEN {_EXACT_PCT} ELSE {_RAW_PCT} END) AS pct FROM raw),
check_result AS (
  SELECT *, 'PL_DEMO' AS pipeline,
         CASE WHEN {_IS_PAIR} OR {_IS_RERUN} THEN CAST(pct AS BIGINT) END AS pct_change,
         CASE WHEN broken THEN 'Error'
              WHEN category = 'KPI' THEN NULL
              WHEN category = 'Row Count' THEN CASE WHEN total_rows > 0 THEN 'Pass' ELSE 'Fail' END
              WHEN category = 'SLA Check Validation' THEN CASE WHEN hours < sla THEN 'Pass' ELSE 'Fail' END
              WHEN family = 'data_quality' THEN CASE WHEN unexpected_rows = 0 THEN 'Pass' ELSE 'Fail' END
              WHEN {_IS_PAIR} THEN {change_status('previous_result', 'current_result', 'pct', False)}
              WHEN {_IS_RERUN} THEN {change_status('previous_result', 'current_result', 'pct', True)}
         END AS status
  FROM changed)"""


def over_result(select: str) -> str:
    """A query over the expected `check_result`."""
    return f"WITH {RESULT_CTES}\n{select}"


def with_views(select: str) -> str:
    """A query over the given tables and the demonstration's views."""
    return f"WITH {VIEW_CTES}\n{select}"


def shown_count(column: str) -> str:
    return f"format('{{:,}}', CAST(coalesce({column}, 0) AS BIGINT))"


def shown_number(column: str) -> str:
    """Thousands separators, with a fraction only where there is one."""
    fraction = f"regexp_extract(CAST({column} AS VARCHAR), '\\.(\\d*?)0*$', 1)"
    shown = f"format('{{:,}}', CAST(trunc({column}) AS BIGINT))"
    return (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN {fraction} = '' THEN {shown} "
        f"ELSE {shown} || '.' || {fraction} END"
    )

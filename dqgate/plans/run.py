"""From configured checks to one long result."""

from __future__ import annotations

import datetime as dt
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate import names as n
from dqgate.functions.formatting import list_text, session_time
from dqgate.functions.threshold import pair_status_sql, pct_change_sql, rerun_status_sql
from dqgate.operators.compare import clean_status_sql, count_status_sql, freshness_status_sql
from dqgate.operators.kpi import kpi_sql, kpi_warehouse, query_text
from dqgate.operators.metrics import (
    Metric,
    hours_since,
    metric_column,
    metric_passes,
    metric_row_sql,
    one_pass,
)
from dqgate.operators.referential import foreign_key_stats
from dqgate.operators.uniqueness import uniqueness_stats
from dqgate.operators.warehouse_metrics import pushable, warehouse_passes
from dqgate.plans.checks import ITEM_COLUMNS, active_checks, check_items
from dqgate.schemas import METRIC_SCHEMA, RESULT_SCHEMA, RESULT_TYPE, STATE_KEYS, STATE_SCHEMA
from dqgate.sinks.state import STATE_KEY_SQL, latest_state
from dqgate.sources.locations import STAGE_LAYERS, Locations, load_table

_ITEM_SCHEMA = f"check_id int, {ITEM_COLUMNS}"


@dataclass(frozen=True)
class RunContext:
    """What identifies a run. All its times come from the one `as_of`."""

    as_of: dt.datetime
    job_id: int = 1
    task_id: int = 1
    created_by: str = "dqgate"
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)


def collect_items(config: DataFrame) -> list[Row]:
    """The active check items, in a stated order.

    The check list shapes the plan, so it is the one thing read by the driver: page by
    page, whatever its length.
    """
    items = check_items(config)
    ordered = items.orderBy(*[c for c in items.columns if c != "error"])
    return list(ordered.toLocalIterator())


class _Tables:
    """Tables of a run by place; each is loaded once, whichever checks use it."""

    def __init__(self, spark: SparkSession, locations: Locations):
        self.spark, self.locations = spark, locations
        self.loaded: dict[tuple, DataFrame] = {}

    def get(self, location_type: str, location: str, layer: str | None) -> tuple[tuple, DataFrame]:
        if location is None:
            raise ValueError("no table location is configured")
        if location_type == n.LOCATION_PATH:
            place = (location_type, self.locations.path(location, self._layer(layer)))
        else:
            place = (location_type, location)
        if place not in self.loaded:
            self.loaded[place] = load_table(
                self.spark, location_type, location, self.locations, self._layer(layer)
            )
        return place, self.loaded[place]

    def path(self, location: str, layer: str | None) -> str:
        return self.locations.path(location, self._layer(layer))

    def _layer(self, layer: str | None) -> str | None:
        return layer if self.locations.layers else None


def _layers_of(item: Row) -> tuple[str | None, str | None]:
    """Layers of the checked table and of its source."""
    if item.family in (n.FAMILY_KPI, n.FAMILY_PRE_POST):
        return item.layer, item.src_layer or item.layer
    layer, source_layer = STAGE_LAYERS.get(item.stage, (None, None))
    layer = layer or item.layer
    if item.category == n.CAT_FOREIGN_KEY:
        # Both tables of a foreign key are in the checked layer unless told otherwise.
        return layer, item.src_layer or layer
    return layer, item.src_layer or source_layer or layer


@dataclass(frozen=True)
class Frame:
    """Metric rows of some checks, computed together."""

    check_ids: tuple[int, ...]
    rows: DataFrame


class _Plan:
    """Collects what each check needs, then builds one plan per table."""

    def __init__(self, spark: SparkSession, locations: Locations):
        self.spark = spark
        self.locations = locations
        self.tables = _Tables(spark, locations)
        self.metrics: dict[tuple, list[tuple[Metric, Column | None]]] = defaultdict(list)
        self.frames: list[Frame] = []
        self.errors: dict[int, str] = {}
        self.queries: dict[int, dict[str, str]] = defaultdict(dict)

    def add(self, check_id: int, item: Row) -> None:
        if item.error:
            self.errors[check_id] = item.error
            return
        try:
            requests = list(self._requests(check_id, item))
        except Exception as problem:  # a bad table or query must not stop the others
            self.errors[check_id] = message_of(problem)
            return
        for request in requests:
            request()

    def _requests(self, check_id: int, item: Row) -> list[Callable[[], None]]:
        layer, src_layer = _layers_of(item)
        category = item.category
        if item.family == n.FAMILY_KPI:
            return self._kpi_requests(check_id, item, layer, src_layer)
        if category == n.CAT_FOREIGN_KEY:
            return self._foreign_key_requests(check_id, item, layer, src_layer)
        place, table = self.tables.get(item.location_type, item.location, layer)
        if category in (n.CAT_ROW_COUNT, n.CAT_PRE_POST):
            return [self._measure(place, table, Metric(check_id, "rows"))]
        if category == n.CAT_SOURCE_DESTINATION:
            src_place, src = self.tables.get(item.src_location_type, item.src_location, src_layer)
            return [
                self._measure(src_place, src, Metric(check_id, "rows", side="src")),
                self._measure(place, table, Metric(check_id, "rows", side="dest")),
            ]
        if category == n.CAT_UNIQUE:
            stats = uniqueness_stats(table, item.columns)
            return [
                self._measure(place, table, Metric(check_id, "rows")),
                self._frame(check_id, "main", stats),
            ]
        kinds = {n.CAT_NULL: "nulls", n.CAT_UNEXPECTED: "in_list", n.CAT_SLA: "latest"}
        metric = Metric(
            check_id, kinds[category], item.columns[0], tuple(item.unexpected_values or ())
        )
        return [self._measure(place, table, metric)]

    def _foreign_key_requests(self, check_id, item, layer, src_layer):
        _, dim = self.tables.get(item.location_type, item.location, layer)
        place, fact = self.tables.get(item.src_location_type, item.src_location, src_layer)
        stats = foreign_key_stats(fact, item.columns[0], dim, item.dest_column)
        return [
            self._measure(place, fact, Metric(check_id, "rows")),
            self._frame(check_id, "main", stats),
        ]

    def _kpi_requests(self, check_id, item, layer, src_layer):
        main_side = "dest" if item.category == n.CAT_KPI_SOURCE_DESTINATION else "main"
        requests = [
            self._kpi(check_id, item, main_side, item.location_type, item.location, layer,
                      item.dest_query)
        ]
        if main_side == "dest":
            requests.append(
                self._kpi(check_id, item, "src", item.src_location_type, item.src_location,
                          src_layer, item.src_query)
            )
        return requests

    def _kpi(self, check_id, item, side, location_type, location, layer, query):
        if location_type == n.LOCATION_PATH:
            place, table = self.tables.get(location_type, location, layer)
            (column,) = item.columns
            shown = query_text(
                item.agg_function, column, self.locations.fmt, self.tables.path(location, layer)
            )
            metric = Metric(check_id, "aggregate", column, function=item.agg_function, side=side)
            request = self._measure(place, table, metric)
        elif location_type == n.LOCATION_CATALOG:
            shown = query
            request = self._frame(check_id, side, kpi_sql(self.spark, query))
        elif location_type == n.LOCATION_WAREHOUSE:
            shown = query
            request = self._frame(
                check_id, side, kpi_warehouse(self.spark, self.locations.warehouse, query)
            )
        else:
            raise ValueError(f"unknown location type {location_type!r}")
        self.queries[check_id]["src" if side == "src" else "dest"] = shown
        return request

    def _measure(self, place: tuple, table: DataFrame, metric: Metric) -> Callable[[], None]:
        column = metric_column(table, metric)  # a wrong column shows here, for this check alone
        return lambda: self.metrics[place].append((metric, column))

    def _frame(self, check_id: int, side: str, stats: DataFrame) -> Callable[[], None]:
        frame = Frame((check_id,), _as_metric_rows(check_id, side, stats))
        return lambda: self.frames.append(frame)

    def all_frames(self) -> list[Frame]:
        fused = []
        for place, metrics in self.metrics.items():
            table = self.tables.loaded[place]
            if place[0] == n.LOCATION_WAREHOUSE:
                # What the warehouse can count itself is not transferred.
                sent = [m for m, _ in metrics if pushable(table.schema, m)]
                for taken, rows in warehouse_passes(self.spark, self.locations.warehouse, table, place[1], sent):
                    fused.append(Frame(tuple(dict.fromkeys(m.check_id for m in taken)), rows))
                metrics = [planned for planned in metrics if not pushable(table.schema, planned[0])]
            for taken in metric_passes(metrics):
                ids = tuple(dict.fromkeys(m.check_id for m, _ in taken))
                fused.append(Frame(ids, one_pass(table, taken)))
        return [*fused, *self.frames]


def message_of(problem: Exception) -> str:
    text = str(problem).strip().split("\n")[0]
    return f"{type(problem).__name__}: {text}"


def _as_metric_rows(check_id: int, side: str, stats: DataFrame) -> DataFrame:
    row = metric_row_sql(check_id, side, {c: c for c in stats.columns})
    return stats.selectExpr(f"inline(array({row}))")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union as a balanced tree, so that many checks do not make a deep plan."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [
            frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
            for i in range(0, len(frames), 2)
        ]
    return frames[0]


def _of_side(column: str, side: str) -> str:
    return f"max(CASE WHEN side = '{side}' THEN {column} END)"


# All metrics of a check in one row; each metric is given by one row at most.
_PER_CHECK = {
    "main_rows": _of_side("total_rows", "main"),
    "src_rows": _of_side("total_rows", "src"),
    "dest_rows": _of_side("total_rows", "dest"),
    "unexpected_rows": "max(unexpected_rows)",
    "unexpected_keys": "max(unexpected_keys)",
    "main_value": _of_side("value", "main"),
    "src_value": _of_side("value", "src"),
    "dest_value": _of_side("value", "dest"),
    "main_text": _of_side("value_text", "main"),
    "src_text": _of_side("value_text", "src"),
    "dest_text": _of_side("value_text", "dest"),
    "latest": "max(as_of_max)",
    "error": "max(error)",
}


def _per_check(metric_rows: DataFrame) -> DataFrame:
    return metric_rows.groupBy("check_id").agg(
        *[F.expr(sql).alias(name) for name, sql in _PER_CHECK.items()]
    )


def _category_in(*categories: str) -> str:
    return "category IN ({})".format(", ".join(f"'{c}'" for c in categories))


_QUALITY = _category_in(n.CAT_NULL, n.CAT_UNEXPECTED, n.CAT_UNIQUE, n.CAT_FOREIGN_KEY)
_PAIRS = _category_in(n.CAT_SOURCE_DESTINATION, n.CAT_KPI_SOURCE_DESTINATION)
_RERUNS = _category_in(n.CAT_PRE_POST, n.CAT_KPI_PRE_POST)
_FOREIGN_KEY = f"category = '{n.CAT_FOREIGN_KEY}'"

_NUMBER = RESULT_TYPE.simpleString()
_PREVIOUS = f"""
    CASE WHEN category = '{n.CAT_SOURCE_DESTINATION}' THEN CAST(src_rows AS {_NUMBER})
         WHEN category = '{n.CAT_KPI_SOURCE_DESTINATION}' THEN src_value
         WHEN {_RERUNS} THEN stored_result END"""
_CURRENT = f"""
    CASE WHEN {_category_in(n.CAT_ROW_COUNT, n.CAT_PRE_POST)} THEN CAST(main_rows AS {_NUMBER})
         WHEN category = '{n.CAT_SOURCE_DESTINATION}' THEN CAST(dest_rows AS {_NUMBER})
         WHEN category = '{n.CAT_KPI_SOURCE_DESTINATION}' THEN dest_value
         WHEN category = '{n.CAT_SLA}' THEN CAST(hours AS {_NUMBER})
         ELSE main_value END"""
_RESULT_TEXT = f"""
    CASE WHEN category = '{n.CAT_KPI_SOURCE_DESTINATION}' THEN dest_text
         WHEN {_category_in(n.CAT_KPI_PRE_POST, n.CAT_KPI_RESULT)} THEN main_text END"""
# A comparison needs numbers; what was measured but is none is reported, not passed over.
_NOT_A_NUMBER = f"""
    CASE WHEN category = '{n.CAT_KPI_PRE_POST}' AND main_value IS NULL
         THEN concat('result cannot be compared as a number: ', main_text)
         WHEN category = '{n.CAT_KPI_SOURCE_DESTINATION}'
         THEN concat('result cannot be compared as a number: ',
              coalesce(CASE WHEN src_value IS NULL THEN src_text END, CASE WHEN dest_value IS NULL THEN dest_text END))
         END"""
_STATUS = f"""
    CASE WHEN error IS NOT NULL THEN '{n.ERROR}'
         WHEN category = '{n.CAT_KPI_RESULT}' THEN NULL
         WHEN category = '{n.CAT_ROW_COUNT}' THEN {count_status_sql("main_rows")}
         WHEN {_QUALITY} THEN {clean_status_sql("unexpected_rows")}
         WHEN category = '{n.CAT_SLA}' THEN {freshness_status_sql("hours", "sla_threshold")}
         WHEN {_PAIRS} THEN {pair_status_sql("previous_result", "current_result")}
         WHEN {_RERUNS} THEN {rerun_status_sql("previous_result", "current_result")} END"""

# Result columns that are not simply taken over.
_RESULT = {
    "table_name": f"CASE WHEN {_FOREIGN_KEY} THEN src_table "
    f"WHEN category IS NULL OR NOT {_PAIRS} THEN table_name END",
    "src_table": f"CASE WHEN {_PAIRS} OR {_FOREIGN_KEY} THEN src_table END",
    "dest_table": f"CASE WHEN {_PAIRS} OR {_FOREIGN_KEY} THEN table_name END",
    "total_rows": "coalesce(main_rows, dest_rows)",
    "result_text": _RESULT_TEXT,
    "pct_change": f"CASE WHEN {_PAIRS} THEN {pct_change_sql('previous_result', 'current_result')} "
    f"WHEN {_RERUNS} THEN {pct_change_sql('previous_result', 'current_result', True)} END",
    "status": _STATUS,
}


def _judged(measured: DataFrame, items: DataFrame, state: DataFrame, ctx: RunContext) -> DataFrame:
    as_of = session_time(ctx.as_of)
    joined = measured.join(F.broadcast(items.drop("error")), "check_id").withColumns(
        {
            "hours": hours_since(F.col("latest"), as_of),
            "state_key": F.expr(STATE_KEY_SQL),
            "error": F.expr(f"coalesce(error, {_NOT_A_NUMBER})"),
        }
    )
    stored = latest_state(state).selectExpr(
        *[f"{k} AS _{k}" for k in STATE_KEYS], "result AS stored_result"
    )
    same_key = F.expr(
        f"{_RERUNS} AND pipeline = _pipeline AND stage = _stage AND check_type = _check_type "
        "AND coalesce(layer, '') = _layer AND state_key = _state_key"
    )
    valued = joined.join(stored, same_key, "left").selectExpr(
        "*", f"{_PREVIOUS} AS previous_result", f"{_CURRENT} AS current_result"
    )
    given = {
        "run_id": F.lit(ctx.run_id),
        "job_id": F.lit(ctx.job_id),
        "task_id": F.lit(ctx.task_id),
        "column_name": F.when(F.expr("size(columns) > 1"), list_text(F.col("columns"))).otherwise(
            F.expr("get(columns, 0)")
        ),
        "unexpected_value": list_text(F.col("unexpected_values")),
        "created_by": F.lit(ctx.created_by),
        "created_at": as_of,
    }

    def column(field: T.StructField) -> Column:
        value = given.get(field.name)
        if value is None:
            value = F.expr(_RESULT.get(field.name, field.name))
        return value.cast(field.dataType).alias(field.name)

    return valued.select(*[column(f) for f in RESULT_SCHEMA.fields])


@dataclass(frozen=True)
class PlannedRun:
    """A run before it is computed: what is checked, and the frames to compute."""

    spark: SparkSession
    items: list[Row]
    queries: dict[int, dict[str, str]]
    errors: dict[int, str]
    frames: list[Frame]
    ids: list[int] | None = None  # of the items, if they are not all of the plan's

    def of_stage(self, pipeline: str, stage: str) -> PlannedRun:
        """The part of a plan that judges one stage; metrics keep the ids of the whole plan."""
        ids = [i for i, item in enumerate(self.items) if (item.pipeline, item.stage) == (pipeline, stage)]
        return replace(self, items=[self.items[i] for i in ids], ids=ids)

    def judge(
        self,
        metric_rows: Sequence[DataFrame],
        ctx: RunContext,
        state: DataFrame | None = None,
        late_errors: Mapping[int, str] | None = None,
    ) -> DataFrame:
        """The long result, from the metric rows of all frames.

        `late_errors` are checks whose metrics could not be computed.
        """
        errors = {**(late_errors or {}), **self.errors}
        ids = range(len(self.items)) if self.ids is None else self.ids
        every_check = self.spark.createDataFrame(
            [(i, "main", *[None] * 6, errors.get(i)) for i in ids],
            METRIC_SCHEMA,
        )
        listed = []
        for check_id, item in zip(ids, self.items, strict=True):
            shown = self.queries.get(check_id, {})
            values = item.asDict()
            values["src_query"] = shown.get("src", item.src_query)
            values["dest_query"] = shown.get("dest", item.dest_query)
            listed.append((check_id, *values.values()))
        items = self.spark.createDataFrame(listed, T.StructType.fromDDL(_ITEM_SCHEMA))
        if state is None:
            state = self.spark.createDataFrame([], STATE_SCHEMA)
        return _judged(_per_check(union_all([every_check, *metric_rows])), items, state, ctx)


def prepare_run(
    spark: SparkSession,
    config: DataFrame,
    locations: Locations,
    pipeline: str | None = None,
    stage: str | None = None,
) -> PlannedRun:
    """Plans all active checks without computing any.

    Each table is scanned once for all its counts, null checks, unexpected
    values, freshness and path KPIs together; each unique key and foreign key
    adds one plan over its key columns. What cannot be planned (a missing
    table, a wrong column, a malformed row) becomes an `Error` row.
    """
    rows = collect_items(active_checks(config, pipeline, stage))
    plan = _Plan(spark, locations)
    for check_id, item in enumerate(rows):
        plan.add(check_id, item)
    return PlannedRun(spark, rows, plan.queries, plan.errors, plan.all_frames())


def plan_run(
    spark: SparkSession,
    config: DataFrame,
    locations: Locations,
    ctx: RunContext,
    state: DataFrame | None = None,
    pipeline: str | None = None,
    stage: str | None = None,
) -> DataFrame:
    """The long result of all active checks, as one lazy DataFrame."""
    planned = prepare_run(spark, config, locations, pipeline, stage)
    return planned.judge([f.rows for f in planned.frames], ctx, state)

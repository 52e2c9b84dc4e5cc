"""Runs of many pipelines and stages, written once and kept apart from each other."""

from __future__ import annotations

import hashlib
import re
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate import names as n
from dqgate.plans.checks import active_checks, flag_sql, runs_of
from dqgate.plans.results import (
    DETAIL_COLUMNS,
    audit_history,
    detail,
    kpi_summary,
    stage_gate,
    summary_by_category,
    summary_by_layer,
)
from dqgate.plans.run import (
    Frame,
    PlannedRun,
    RunContext,
    message_of,
    plan_run,
    prepare_run,
    union_all,
)
from dqgate.schemas import METRIC_SCHEMA, RESULT_SCHEMA
from dqgate.sinks.history import append_history, append_history_table
from dqgate.sinks.layers import overwrite, path_exists, remove_path
from dqgate.sinks.state import read_state, save_state, state_of
from dqgate.sources.jdbc import Warehouse
from dqgate.sources.locations import Locations


# Tables and keys computed by one job; see `compute`.
FRAMES_PER_JOB = 64
# Tables and keys of one job of a run that can be resumed: what is lost when it is cut off.
FRAMES_PER_UNIT = 16


@dataclass(frozen=True)
class Output:
    """Where a deployment keeps its results: the latest per pipeline and stage, the
    run state, and the audit history, the last optionally in a warehouse table too."""

    base: str
    audit_warehouse: Warehouse | None = None
    audit_table: str | None = None

    @property
    def state(self) -> str:
        return f"{self.base}/state"

    @property
    def history(self) -> str:
        return f"{self.base}/history"

    def run(self, run_id: str) -> str:
        """Where an unfinished run keeps its metrics."""
        return f"{self.base}/_runs/{re.sub('[^0-9A-Za-z_-]', '_', run_id)}-{zlib.crc32(run_id.encode()):08x}"

    def stage(self, pipeline: str, stage: str) -> str:
        return f"{self.base}/results/{pipeline}/{stage}"


def run_all(
    spark: SparkSession,
    config: DataFrame,
    locations: Locations,
    ctx: RunContext,
    state: DataFrame | None = None,
) -> DataFrame:
    """Result of every configured pipeline and stage, as one lazy DataFrame.

    Tables used by several stages are scanned once for all of them.
    """
    return plan_run(spark, config, locations, ctx, state)


def _done(spark: SparkSession, folder: str) -> bool:
    return path_exists(spark, f"{folder}/_SUCCESS")


def _computed(spark: SparkSession, frames: list[Frame], folder: str) -> tuple[list[str], dict[int, str]]:
    """Write the metric rows of frames; returns the folders written and what failed.

    The frames of one job run side by side. When a job fails, its frames are
    tried one by one, so that only the checks of a broken table are lost. What an earlier
    attempt has finished in the same folder is taken as it is.
    """
    if _done(spark, folder):
        return [folder], {}
    try:
        overwrite(union_all([f.rows for f in frames]), folder)
        return [folder], {}
    except Exception as problem:
        if len(frames) == 1:
            return [], dict.fromkeys(frames[0].check_ids, message_of(problem))
    written, failed = [], {}
    for i, frame in enumerate(frames):
        paths, errors = _computed(spark, [frame], f"{folder}-{i}")
        written += paths
        failed.update(errors)
    return written, failed


def compute(
    planned: PlannedRun, folder: str, per_job: int | None = None, at_once: int = 1
) -> tuple[list[DataFrame], dict[int, str]]:
    """Metric rows of a planned run, stored under `folder`, and errors by check.

    A job takes `FRAMES_PER_JOB` frames: enough to keep a cluster busy, few
    enough that re-planning the job as its stages finish stays cheap, however
    many tables are configured. `at_once` jobs run side by side, so the short last stages of one
    leave no executor idle.
    """
    per_job = per_job or FRAMES_PER_JOB
    jobs = [planned.frames[i : i + per_job] for i in range(0, len(planned.frames), per_job)]
    folders = [f"{folder}/{i:06d}" for i in range(len(jobs))]
    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as pool:
        run = inheritable_thread_target(planned.spark)(lambda frames, path: _computed(planned.spark, frames, path))
        done = list(pool.map(run, jobs, folders))
    written = [path for paths, _ in done for path in paths]
    failed = {check: told for _, errors in done for check, told in errors.items()}
    if not written:
        return [], failed
    return [planned.spark.read.schema(METRIC_SCHEMA).parquet(*written)], failed


def _failed_run(
    spark: SparkSession, config: DataFrame, ctx: RunContext, pipeline: str, stage: str, problem: str
) -> DataFrame:
    """One `Error` row that stands for a stage whose job failed."""
    flagged = (
        active_checks(config, pipeline, stage)
        .agg(F.max(F.coalesce(F.expr(flag_sql("IsStageDependency")), F.lit(1))).alias("flag"))
        .select(F.coalesce("flag", F.lit(0)).alias("flag"))
    )
    known = {
        "run_id": F.lit(ctx.run_id),
        "job_id": F.lit(ctx.job_id),
        "task_id": F.lit(ctx.task_id),
        "pipeline": F.lit(pipeline),
        "stage": F.lit(stage),
        "status": F.lit(n.ERROR),
        "error": F.lit(problem),
        "on_stage_depend": F.col("flag"),
        "created_by": F.lit(ctx.created_by),
        "created_at": F.lit(ctx.as_of.isoformat(sep=" ")),
    }
    return flagged.select(
        *[
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RESULT_SCHEMA.fields
        ]
    )


def write_projections(result: DataFrame, folder: str, locations: Locations) -> None:
    """Detail and summary tables of one stage, from its stored result.

    These hold one row per check, so each is written as a single file.
    """
    categories = [
        r[0] for r in result.where(F.col("category").isNotNull()).select("category").distinct().collect()
    ]
    for category in sorted(c for c in categories if c in DETAIL_COLUMNS):
        overwrite(detail(result, category).coalesce(1), f"{folder}/{category}")
    if n.CAT_PRE_POST in categories:
        summary = summary_by_layer(result, locations.layers).drop("pipeline")
    elif set(categories) & {n.CAT_KPI_PRE_POST, n.CAT_KPI_SOURCE_DESTINATION, n.CAT_KPI_RESULT}:
        summary = kpi_summary(result).drop("pipeline")
    else:
        summary = summary_by_category(result).drop("pipeline", "stage")
    overwrite(summary.coalesce(1), f"{folder}/Summary Table")


def run_and_save(
    spark: SparkSession,
    config: DataFrame,
    locations: Locations,
    ctx: RunContext,
    output: Output,
    pipeline: str | None = None,
    stage: str | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Run every pipeline and stage, or the given one, keep the results, and return the gate.

    All stages are planned together and a table is scanned once for all of them, by `at_once`
    jobs side by side. The result of a stage is written before anything is derived from it. A
    run that was cut off goes on where it was when it is started under its `run_id` again. A check whose table cannot be read becomes an
    `Error` row; a stage that cannot be run at all is recorded as one, and the
    others still run. A stage whose results cannot be recorded blocks in the gate. A run
    repeated under its `run_id` replaces its own audit rows, in the history's folder.
    """
    active = active_checks(config, pipeline, stage)
    runs = runs_of(active).orderBy("PipelineName", "StageName").collect()
    if not runs:
        raise ValueError(f"no active checks for pipeline {pipeline!r} and stage {stage!r}")
    shared = _SharedRun(spark, config, locations, ctx, output, pipeline, stage, at_once)
    gates = []
    for pipeline, stage in runs:
        try:
            result = _run_stage(spark, config, locations, ctx, output, pipeline, stage, shared)
        except Exception as problem:  # one stage must not stop the others
            told = f"the stage could not be run or recorded: {message_of(problem)}"
            result = _failed_run(spark, config, ctx, pipeline, stage, told).withColumn("on_stage_depend", F.lit(1))
        gates.append(stage_gate(result))
    shared.finish()
    return union_all(gates)


class _SharedRun:
    """The metrics of all stages of a run: planned together, so a table that several stages check
    is scanned once, and computed when the first stage asks for them.

    They are kept under the run's name until all stages are recorded. A run that is killed and
    started again under its `run_id` finds there what it had finished. The folder also names
    the plan, so that a changed configuration computes anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: DataFrame,
        locations: Locations,
        ctx: RunContext,
        output: Output,
        pipeline: str | None,
        stage: str | None,
        at_once: int,
    ) -> None:
        self.spark, self.ctx, self.at_once = spark, ctx, at_once
        self.of_run = output.run(ctx.run_id)
        self.asked = (config, locations, pipeline, stage)
        self.planned: PlannedRun | None = None
        self.metrics: list[DataFrame] = []
        self.failed: dict[int, str] = {}

    def result(self, pipeline: str, stage: str, state: DataFrame) -> DataFrame:
        """The long result of one stage."""
        if self.planned is None:
            config, locations, *which = self.asked
            planned = prepare_run(self.spark, config, locations, *which)
            told = repr([(item, self.ctx.as_of) for item in planned.items]) + repr([f.check_ids for f in planned.frames])
            folder = f"{self.of_run}/{hashlib.sha256(told.encode()).hexdigest()[:16]}"
            self.metrics, self.failed = compute(planned, folder, FRAMES_PER_UNIT, self.at_once)
            self.planned = planned
        return self.planned.of_stage(pipeline, stage).judge(self.metrics, self.ctx, state, self.failed)

    def finish(self) -> None:
        remove_path(self.spark, self.of_run)


def _run_stage(
    spark: SparkSession,
    config: DataFrame,
    locations: Locations,
    ctx: RunContext,
    output: Output,
    pipeline: str,
    stage: str,
    shared: _SharedRun,
) -> DataFrame:
    """The stored result of one stage, with everything derived from it stored too."""
    folder = output.stage(pipeline, stage)
    stored = f"{folder}/check_result"
    try:
        result = shared.result(pipeline, stage, read_state(spark, output.state))
        overwrite(result.coalesce(1), stored)
    except Exception as problem:
        overwrite(_failed_run(spark, config, ctx, pipeline, stage, message_of(problem)), stored)
    result = spark.read.schema(RESULT_SCHEMA).parquet(stored)
    write_projections(result, folder, locations)
    audit = audit_history(result)
    append_history(audit, output.history, f"{ctx.run_id}-{pipeline}-{stage}")
    if output.audit_warehouse and output.audit_table:
        append_history_table(audit, output.audit_warehouse, output.audit_table)
    if stage in (n.STAGE_PRE_POST, n.STAGE_KPI):
        save_state(spark, state_of(result), output.state)
    return result

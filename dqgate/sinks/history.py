"""Audit history: append, read and retention."""

from __future__ import annotations

import datetime as dt
import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate.functions.formatting import session_time
from dqgate.names import RETENTION_DAYS
from dqgate.schemas import AUDIT_SCHEMA
from dqgate.sinks.jdbc import append_table
from dqgate.sinks.layers import child_names, move, overwrite, remove_path, take_place
from dqgate.sources.jdbc import Warehouse, read_warehouse
from dqgate.sources.listing import data_files, decoded

DAY_COLUMN = "crtd_day"
WRITE_COLUMN = "written_by"
PACKED_COLUMN = "packed_from"
# No write has such a name: the sign is replaced in all names.
_PACK = "packed+"
_STORED_SCHEMA = T.StructType(
    [
        *AUDIT_SCHEMA.fields,
        T.StructField(PACKED_COLUMN, T.StringType()),
        T.StructField(DAY_COLUMN, T.DateType()),
        T.StructField(WRITE_COLUMN, T.StringType()),
    ]
)


def append_history(audit: DataFrame, location: str, written_by: str | None = None) -> None:
    """Append audit rows as parquet, in a folder per day of creation and write.

    Rows that an earlier write of the same name left for the same days are replaced, so
    that a repeated run does not double them. A write without a name adds to all others.
    """
    name = re.sub("[^0-9A-Za-z_-]", "_", written_by)[:80] + f"-{zlib.crc32(written_by.encode()):08x}" if written_by else uuid.uuid4().hex
    folders = [DAY_COLUMN, WRITE_COLUMN]
    named = audit.withColumns({DAY_COLUMN: F.to_date("CRTD_TM"), WRITE_COLUMN: F.lit(name)})
    (
        named.hint("rebalance", DAY_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(location)
    )


def _writes(spark: SparkSession, location: str) -> dict[str, list[str]]:
    """Names of the writes that have a folder, per day."""
    base = location.rstrip("/")
    days = [d for d in child_names(spark, base) if d.startswith(f"{DAY_COLUMN}=")]
    return {
        day.split("=", 1)[1]: [w.split("=", 1)[1] for w in child_names(spark, f"{base}/{day}") if w.startswith(f"{WRITE_COLUMN}=")]
        for day in days
    }


def _stored(spark: SparkSession, location: str) -> DataFrame:
    """The rows that count, with their day and write.

    Of the packs of a day the last counts. A row in a pack is superseded by what its write has
    left in a folder of its own since. So nothing is lost or doubled while a pack takes its place.
    """
    stored = spark.read.schema(_STORED_SCHEMA).parquet(location)
    packs = {day: max(p) for day, names in _writes(spark, location).items() if (p := [n for n in names if n.startswith(_PACK)])}
    if not packs:
        return stored
    is_pack = F.col(WRITE_COLUMN).startswith(_PACK)
    last = F.concat_ws("/", DAY_COLUMN, WRITE_COLUMN).isin([f"{day}/{name}" for day, name in packs.items()])
    plain = stored.where(~is_pack)
    later = plain.select(F.col(DAY_COLUMN), F.col(WRITE_COLUMN).alias(PACKED_COLUMN)).distinct()
    return plain.unionByName(stored.where(is_pack & last).join(later, [DAY_COLUMN, PACKED_COLUMN], "left_anti"))


def read_history(spark: SparkSession, location: str) -> DataFrame:
    return _stored(spark, location).select(*AUDIT_SCHEMA.names)


def compact_history(spark: SparkSession, location: str, least_writes: int = 16) -> list[str]:
    """Pack the writes of each day that has at least `least_writes` of them; gives these days.

    All days are packed in one job, into few files per day. Rows keep the name of their write, so a
    repeated run still replaces its own rows. Folders of writes leave by one rename each, unless a
    repeated run has written to them since. A compaction that was cut off changes no row; the next
    one goes on. One compaction at a time may run.
    """
    base, writes = location.rstrip("/"), _writes(spark, location)
    days = sorted(d for d, names in writes.items() if sum(not n.startswith(_PACK) for n in names) >= least_writes)
    if not days:
        return []
    turn = 1 + max((int(n[len(_PACK) :]) for names in writes.values() for n in names if n.startswith(_PACK)), default=0)
    pack, stage = f"{_PACK}{turn:08d}", f"{base}/_pack_{uuid.uuid4().hex}"
    files = [
        (decoded(spark, r["folder"]), decoded(spark, r["file"]))
        for day in days
        for r in data_files(spark, f"{base}/{DAY_COLUMN}={day}").select("folder", "file").collect()
    ]
    rows = _stored(spark, location).where(F.col(DAY_COLUMN).cast("string").isin(days))
    written_by = F.col(WRITE_COLUMN)
    named = rows.withColumn(PACKED_COLUMN, F.coalesce(PACKED_COLUMN, written_by)).withColumn(WRITE_COLUMN, F.lit(pack))
    overwrite(named, stage, partition_by=[DAY_COLUMN, WRITE_COLUMN])
    for day in days:
        folder = f"{DAY_COLUMN}={day}/{WRITE_COLUMN}={pack}"
        if child_names(spark, f"{stage}/{folder}"):
            move(spark, f"{stage}/{folder}", f"{base}/{folder}")
    packed: dict[str, set[str]] = {}
    for folder, file in files:
        packed.setdefault(folder, set()).add(file.rsplit("/", 1)[1])
    for i, (folder, names) in enumerate(packed.items()):
        # As a whole, since the rest of a write would supersede its rows in the pack.
        if {n for n in child_names(spark, folder) if not n.startswith((".", "_"))} <= names:
            move(spark, folder, f"{stage}/_old/{i}")
    remove_path(spark, stage)
    spark.catalog.refreshByPath(location)
    return days


def append_history_table(audit: DataFrame, warehouse: Warehouse, table: str) -> None:
    append_table(audit, warehouse, table)


def read_history_table(spark: SparkSession, warehouse: Warehouse, table: str) -> DataFrame:
    return read_warehouse(spark, warehouse, table)


def retained(history: DataFrame, as_of: dt.datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """History rows created within the last `days` days."""
    return history.where(F.col("CRTD_TM") >= session_time(as_of - dt.timedelta(days=days)))


def purge_history(
    spark: SparkSession, location: str, as_of: dt.datetime, days: int = RETENTION_DAYS
) -> None:
    """Remove history older than `days` days from storage.

    Whole days are dropped as folders, without reading them. Only the day the
    limit falls into is rewritten.
    """
    limit = as_of - dt.timedelta(days=days)
    stored = spark.read.schema(_STORED_SCHEMA).parquet(location)
    day = limit.date()
    old_days = [
        r[0]
        for r in stored.where(F.col(DAY_COLUMN) < F.lit(day)).select(DAY_COLUMN).distinct().collect()
    ]
    boundary = _stored(spark, location).where(F.col(DAY_COLUMN) == F.lit(day))
    expired = boundary.where(F.col("CRTD_TM") < session_time(limit)).limit(1).count()
    if expired:
        kept = boundary.where(F.col("CRTD_TM") >= session_time(limit))
        stage = f"{location.rstrip('/')}__purge_{day:%Y%m%d}"
        overwrite(kept.drop(DAY_COLUMN), stage, partition_by=[WRITE_COLUMN])
        take_place(spark, stage, f"{location.rstrip('/')}/{DAY_COLUMN}={day.isoformat()}")
    for old in old_days:
        remove_path(spark, f"{location.rstrip('/')}/{DAY_COLUMN}={old.isoformat()}")

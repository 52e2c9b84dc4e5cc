"""Writes into a layer: overwrite, append and keyed upsert."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate.functions import sizes
from dqgate.functions.columns import quoted
from dqgate.functions.sizes import row_bytes
from dqgate.session import scratch_dir

# Fixed value: lets Delta tables have column names with any characters.
_DELTA_OPTIONS = {"delta.columnMapping.mode": "name"}


def write_options(fmt: str, **delta_only: str) -> dict[str, str]:
    return {**_DELTA_OPTIONS, **delta_only} if fmt == "delta" else {}


def by_folder(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition folder brought together, so that it gets few files;
    a folder with very many rows is split over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite(
    df: DataFrame, location: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace the data and the schema at a location.

    The number of files follows the plan's partitions; nothing is squeezed into
    one file.
    """
    writer = by_folder(df, partition_by).write.format(fmt).mode("overwrite")
    options = write_options(fmt, overwriteSchema="true")
    writer.options(**options).partitionBy(*partition_by).save(location)


def append(
    df: DataFrame, location: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    writer = by_folder(df, partition_by).write.format(fmt).mode("append")
    writer.options(**write_options(fmt)).partitionBy(*partition_by).save(location)


def _all_set(columns: Sequence[Column]) -> Column:
    return reduce(and_, [c.isNotNull() for c in columns])


def check_upsert_source(source: DataFrame, primary_keys: Sequence[str]) -> int:
    """Measured size of the source in bytes; raises when a key without nulls occurs twice."""
    keys = [quoted(k) for k in primary_keys]
    per_key = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row_bytes(source)).alias("n_bytes")
    )
    stats = per_key.agg(
        F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
        F.count_if(_all_set(keys) & (F.col("n_rows") > 1)).alias("repeated"),
    ).first()
    if stats["repeated"]:
        raise ValueError(
            f"upsert source holds {stats['repeated']} repeated keys of {list(primary_keys)}"
        )
    return int(stats["n_bytes"])


def _updated(target: DataFrame, primary_keys: Sequence[str], source: DataFrame) -> DataFrame:
    """All target rows; matched ones take every column the source has."""
    changes = source.select(
        F.lit(True).alias("_changed"), *[quoted(c).alias(f"_new_{c}") for c in source.columns]
    )
    matches = reduce(and_, [quoted(k) == quoted(f"_new_{k}") for k in primary_keys])
    out = []
    for column in target.columns:
        if column in source.columns and column not in primary_keys:
            new = quoted(f"_new_{column}")
            out.append(F.when(F.col("_changed"), new).otherwise(quoted(column)).alias(column))
        else:
            out.append(quoted(column))
    return target.join(changes, matches, "left").select(*out)


def merged(
    target: DataFrame,
    source: DataFrame,
    primary_keys: Sequence[str],
    broadcast_source: bool = False,
) -> DataFrame:
    """MERGE as a query: update rows with an equal key, insert the others, keep the rest.

    Null keys never match. Target columns the source lacks keep their value on
    update and are null on insert.

    The target is the streamed side of a left join, so a key that many target
    rows share is never buffered and its partition can be split. What is new in
    the source is found by an anti join with the target's distinct keys. A source
    small enough to broadcast spares the target any shuffle. Otherwise rows
    without a whole key go around the joins, so they cannot pile up in one task.
    """
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns missing in the target: {unknown}")
    source = source.select(
        *[quoted(c).cast(target.schema[c].dataType).alias(c) for c in source.columns]
    )
    keys = list(primary_keys)
    key_columns = [quoted(k) for k in keys]
    if broadcast_source:
        source_keys = F.broadcast(source.select(*key_columns))
        existing = target.select(*key_columns).join(source_keys, keys, "left_semi").distinct()
        inserted = source.join(existing, keys, "left_anti")
        return _updated(target, keys, F.broadcast(source)).unionByName(
            inserted, allowMissingColumns=True
        )
    has_key = _all_set(key_columns)
    keyed_target, keyed_source = target.where(has_key), source.where(has_key)
    existing = keyed_target.select(*key_columns).distinct()
    inserted = keyed_source.join(existing, keys, "left_anti")
    return (
        _updated(keyed_target, keys, keyed_source)
        .unionByName(target.where(~has_key))
        .unionByName(inserted, allowMissingColumns=True)
        .unionByName(source.where(~has_key), allowMissingColumns=True)
    )


def _touched(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> Column:
    """Filter on the partitions the source touches.

    It names partition values only, as many as there are: the driver holds those of the
    whole table anyway to list its files.
    """
    columns = [quoted(c).cast(target.schema[c].dataType).alias(c) for c in partition_by]
    named = source.select(F.to_json(F.struct(*columns)).alias("part")).distinct().collect()
    if not named:
        return F.lit(False)
    return F.to_json(F.struct(*[quoted(c) for c in partition_by])).isin([r["part"] for r in named])


def partition_columns(spark: SparkSession, location: str) -> list[str]:
    """The columns whose values name the folders of a table."""
    fs, path = _file_system(spark, location)
    found: list[str] = []
    while True:
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        level = next((x for x in names if "=" in x and not x.startswith(("_", "."))), None)
        if level is None:
            return found
        found.append(level.split("=", 1)[0])
        path = spark._jvm.org.apache.hadoop.fs.Path(path, level)


def upsert(
    spark: SparkSession,
    source: DataFrame,
    location: str,
    primary_keys: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Merge `source` into the table at `location`.

    Delta tables use their own MERGE. Other formats are merged into a complete
    copy beside the table, which then takes its place: readers see the old or
    the new table, and a failed job leaves the old one untouched. A table
    partitioned by part of its primary key is only read and rewritten in the
    partitions the source touches. Where matched keys lie in few of the files, only these are
    rewritten: the new files are finished first and listed in a journal, then they are moved in
    and the old ones removed. A merge that is cut off in that last step is finished by the next
    one (or by `finish_merges`); until then, and for the moment the step takes, readers may
    see a changed row twice. The table keeps its partition columns; `partition_by`
    need only be given to change them.

    The source is computed once, into the shared folder, so that what is checked is what is
    merged.
    """
    kept = scratch_dir(spark, "upsert-source")
    source.write.parquet(kept)
    source = spark.read.schema(source.schema).parquet(kept)
    try:
        _upsert(spark, source, location, primary_keys, fmt, partition_by)
    finally:
        remove_path(spark, kept)


def _upsert(
    spark: SparkSession,
    source: DataFrame,
    location: str,
    primary_keys: Sequence[str],
    fmt: str,
    partition_by: Sequence[str],
) -> None:
    small = check_upsert_source(source, primary_keys) <= sizes.BROADCAST_BYTES
    if fmt != "delta":
        finish_merges(spark, location)
    if fmt == "delta":
        _delta_merge(spark, source, location, primary_keys)
        return
    target = spark.read.format(fmt).load(location)
    layout = partition_columns(spark, location)
    same_layout = not partition_by or list(partition_by) == layout
    partition_by = partition_by or layout
    stage = f"{location.rstrip('/')}__merge_{uuid.uuid4().hex}"
    touched = None
    if partition_by and same_layout and set(partition_by) <= set(primary_keys):
        touched = _touched(target, source, partition_by)
    if touched is None:
        files = _files_to_rewrite(spark, source, location, primary_keys, fmt, small) if same_layout else None
        if files is not None:
            _merge_files(spark, source, target, location, files, primary_keys, fmt, partition_by, stage, small)
            return
        overwrite(merged(target, source, primary_keys, small), stage, fmt, partition_by)
        take_place(spark, stage, location)
        return
    overwrite(merged(target.where(touched), source, primary_keys, small), stage, fmt, partition_by)
    (
        by_folder(spark.read.schema(target.schema).format(fmt).load(stage), partition_by)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(location)
    )
    remove_path(spark, stage)


# A merge rewrites single files if it leaves at least this share of them alone.
SPARED_SHARE = 0.5
_JOURNAL = "_merges"


def _is_plain(path: str) -> bool:
    return not any(c in path for c in "*?[]{}\\")


def _data_files(spark: SparkSession, location: str) -> int:
    """Files of a table that hold rows; hidden ones aside."""
    fs, root = _file_system(spark, location)
    found, folders = 0, [root]
    while folders:
        for status in fs.listStatus(folders.pop()):
            if status.getPath().getName().startswith(("_", ".")):
                continue
            if status.isDirectory():
                folders.append(status.getPath())
            else:
                found += 1
    return found


def _files_to_rewrite(
    spark: SparkSession, source: DataFrame, location: str, primary_keys: Sequence[str], fmt: str, small: bool
) -> list[str] | None:
    """The files that hold a key of the source; None if they are too many to be worth it.

    Only the key columns are read. The driver gets file names, of which it lists all anyway.
    """
    if not _is_plain(location):
        return None
    target = spark.read.format(fmt).load(location)
    keys = [quoted(k).cast(target.schema[k].dataType).alias(k) for k in primary_keys]
    named = target.select(*[quoted(k) for k in primary_keys], F.col("_metadata.file_path").alias("_file"))
    wanted = source.select(*keys)
    found = named.join(F.broadcast(wanted) if small else wanted, list(primary_keys), "left_semi").select("_file").distinct()
    jvm = spark._jvm
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_file"])).toString() for r in found.collect()]
    if len(files) > (1 - SPARED_SHARE) * _data_files(spark, location) or not all(map(_is_plain, files)):
        return None
    return files


def _merge_files(
    spark: SparkSession,
    source: DataFrame,
    target: DataFrame,
    location: str,
    files: list[str],
    primary_keys: Sequence[str],
    fmt: str,
    partition_by: Sequence[str],
    stage: str,
    small: bool,
) -> None:
    """Merge into the files that hold the source's keys, and leave all others as they are."""
    if files:
        held = spark.read.schema(target.schema).format(fmt).option("basePath", location).load(files)
    else:
        held = target.where("false")
    overwrite(merged(held, source, primary_keys, small), stage, fmt, partition_by)
    fs, journal = _file_system(spark, f"{location.rstrip('/')}/{_JOURNAL}/{stage.rpartition('__merge_')[2]}.json")
    out = fs.create(journal, False)
    try:
        out.write(bytearray(json.dumps({"stage": stage, "remove": files}).encode()))
    finally:
        out.close()
    finish_merges(spark, location)


def finish_merges(spark: SparkSession, location: str) -> int:
    """Finish merges of single files whose new files are complete; gives their number.

    Each step can be repeated: files that have been moved or removed are passed over.
    """
    fs, folder = _file_system(spark, f"{location.rstrip('/')}/{_JOURNAL}")
    if not fs.exists(folder):
        return 0
    path = spark._jvm.org.apache.hadoop.fs.Path
    journals = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
    for journal in journals:
        told = json.loads(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(fs.open(journal)).decode())
        stage = path(told["stage"])
        folders = [(stage, path(location))] if fs.exists(stage) else []
        while folders:
            here, there = folders.pop()
            fs.mkdirs(there)
            for status in fs.listStatus(here):
                name = status.getPath().getName()
                if name.startswith(("_", ".")):
                    continue
                if status.isDirectory():
                    folders.append((status.getPath(), path(there, name)))
                elif not fs.rename(status.getPath(), path(there, name)):
                    raise OSError(f"cannot move {status.getPath()} into {there}; the merge is listed in {journal}")
        for old in told["remove"]:
            fs.delete(path(old), False)
        fs.delete(stage, True)
        fs.delete(journal, False)
    fs.delete(folder, True)
    spark.catalog.refreshByPath(location)
    return len(journals)


def _delta_merge(
    spark: SparkSession, source: DataFrame, location: str, primary_keys: Sequence[str]
) -> None:
    from delta.tables import DeltaTable

    condition = " AND ".join(f"t.`{k}` = s.`{k}`" for k in primary_keys)
    changed = {f"`{c}`": f"s.`{c}`" for c in source.columns if c not in primary_keys}
    (
        DeltaTable.forPath(spark, location)
        .alias("t")
        .merge(source.alias("s"), condition)
        .whenMatchedUpdate(set=changed)
        .whenNotMatchedInsert(values={f"`{c}`": f"s.`{c}`" for c in source.columns})
        .execute()
    )


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return bool(fs.exists(target))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is missing."""
    fs, target = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def take_place(spark: SparkSession, stage: str, location: str) -> None:
    """Put the finished copy where the table was: two renames, no data is moved."""
    fs, new = _file_system(spark, stage)
    _, current = _file_system(spark, location)
    # Hidden from readers of the folder above.
    parent, _, name = location.rstrip("/").rpartition("/")
    _, old = _file_system(spark, f"{parent}/_old_{name}_{uuid.uuid4().hex}")
    if not fs.rename(current, old):
        raise OSError(f"cannot set {location} aside; the merged table is at {stage}")
    if not fs.rename(new, current):
        fs.rename(old, current)
        raise OSError(f"cannot replace {location}; the merged table is at {stage}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(location)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder; what is above the target is made."""
    fs, old = _file_system(spark, path)
    _, new = _file_system(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {path} to {target}")


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file that says that something is done."""
    fs, target = _file_system(spark, path)
    fs.create(target, True).close()

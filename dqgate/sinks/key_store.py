"""Uniqueness of a table that grows by folders: keys are counted once per folder and kept.

The store holds, for each folder of the table, its keys with their number of rows. Counts of
folders add up, so a later run reads only folders that are new or have changed, and adds
the kept counts of the others. Repeats across folders are found.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate.functions.columns import resolve
from dqgate.functions.keys import compact_key
from dqgate.operators.uniqueness import counted_stats, key_names, some_part
from dqgate.sinks.layers import child_names, path_exists, remove_path
from dqgate.sources.listing import data_files, decoded, folder_of

_FOLDER = "folder_id"
_KNOWN_SCHEMA = f"{_FOLDER} string, state string"


def _folder_id(folder):
    return F.sha2(folder, 256)


def folder_states(spark: SparkSession, location: str) -> DataFrame:
    """`folder, folder_id, state`: the state changes with the names, sizes and times of the folder's files."""
    seen = data_files(spark, location).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.max("modified").alias("latest"),
        F.bit_xor(F.xxhash64("file", "bytes", "modified")).alias("mixed"),
    )
    told = F.concat_ws("|", "files", "bytes", F.unix_micros("latest"), "mixed")
    return seen.select("folder", _folder_id(F.col("folder")).alias(_FOLDER), told.alias("state"))


def _place(table: DataFrame, keys: Sequence[str], store: str) -> str:
    """The part of the store for these keys: other columns or types never meet in it."""
    names = [resolve(table, k) for k in keys]
    told = ",".join(f"{n}:{table.schema[n].dataType.simpleString()}" for n in names)
    return f"{store.rstrip('/')}/keys-{zlib.crc32(told.encode()):08x}-{len(names)}"


def _last_note(spark: SparkSession, place: str) -> int:
    """Number of the last whole note of what is counted; 0 if there is none."""
    turns = [int(n) for n in child_names(spark, f"{place}/known") if n.isdigit()]
    return max((t for t in turns if path_exists(spark, f"{place}/known/{t}/_SUCCESS")), default=0)


def _known(spark: SparkSession, place: str) -> DataFrame:
    turn = _last_note(spark, place)
    if not turn:
        return spark.createDataFrame([], _KNOWN_SCHEMA)
    return spark.read.schema(_KNOWN_SCHEMA).parquet(f"{place}/known/{turn}")


def _note(spark: SparkSession, known: DataFrame, place: str) -> None:
    """Replace the note by a new one, which counts once it is whole."""
    turn = _last_note(spark, place) + 1
    known.select(_FOLDER, "state").coalesce(1).write.mode("overwrite").parquet(f"{place}/known/{turn}")
    if turn > 1:
        remove_path(spark, f"{place}/known/{turn - 1}")


def refresh_keys(
    spark: SparkSession, location: str, keys: Sequence[str], store: str, fmt: str = "parquet"
) -> list[str]:
    """Count the keys of folders that are new or have changed; gives the folders that were read.

    A folder is struck from the note of what is counted before its old counts go, and noted again
    when the new ones are whole, so a run that was cut off counts it again. The table must
    hold still meanwhile, and one run at a time may use a store. The driver gets names of
    folders, of which it lists all anyway.
    """
    table = spark.read.format(fmt).load(location)
    place = _place(table, keys, store)
    current, known = folder_states(spark, location), _known(spark, place)
    new = current.join(known, [_FOLDER, "state"], "left_anti").select("folder", _FOLDER).collect()
    gone = known.join(current, [_FOLDER, "state"], "left_anti").select(_FOLDER).collect()
    if gone:
        _note(spark, known.join(current, [_FOLDER, "state"], "left_semi"), place)
        for row in gone:
            remove_path(spark, f"{place}/counts/{_FOLDER}={row[_FOLDER]}")
    if not new:
        return []
    folders = [decoded(spark, r["folder"]) for r in new]
    rows = spark.read.schema(table.schema).format(fmt).option("basePath", location).load(folders)
    names = key_names(keys)
    keyed = rows.select(
        _folder_id(folder_of(F.col("_metadata.file_path"))).alias(_FOLDER),
        *[compact_key(rows, resolve(rows, k)).alias(n) for k, n in zip(keys, names, strict=True)],
    )
    counted = (
        keyed.where(some_part([F.col(n) for n in names]))
        .groupBy(_FOLDER, *names)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    (
        counted.hint("rebalance", _FOLDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_FOLDER)
        .parquet(f"{place}/counts")
    )
    _note(spark, current, place)
    return sorted(folders)


def kept_key_counts(
    spark: SparkSession, location: str, keys: Sequence[str], store: str, fmt: str = "parquet"
) -> DataFrame:
    """Rows per key as `n_rows`, from the kept counts of all folders; the table is not read.

    Of the table only the schema is needed. Keys that are null in every part are left out.
    """
    table = spark.read.format(fmt).load(location)
    place, names = _place(table, keys, store), key_names(keys)
    keyed = table.select(*[compact_key(table, resolve(table, k)).alias(n) for k, n in zip(keys, names, strict=True)])
    if not any(n.startswith(f"{_FOLDER}=") for n in child_names(spark, f"{place}/counts")):
        return keyed.where("false").groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema]
    stored = spark.read.schema(", ".join([*fields, "n_rows bigint", f"{_FOLDER} string"])).parquet(f"{place}/counts")
    whole = stored.join(_known(spark, place).select(_FOLDER), _FOLDER, "left_semi")
    return whole.groupBy(*names).agg(F.sum("n_rows").alias("n_rows"))


def kept_uniqueness_stats(
    spark: SparkSession, location: str, keys: Sequence[str], store: str, fmt: str = "parquet"
) -> DataFrame:
    """What `uniqueness_stats` says of the whole table, after reading new and changed folders only."""
    refresh_keys(spark, location, keys, store, fmt)
    return counted_stats(kept_key_counts(spark, location, keys, store, fmt))

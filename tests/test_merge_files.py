"""Merges that rewrite only the files that hold matched keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dqgate.sinks import layers
from dqgate.sinks.layers import finish_merges, overwrite, upsert
from tests.conftest import rows

SCHEMA = "id long, name string, n int"


def files(place):
    from pathlib import Path

    return {str(p.relative_to(place)): p.stat().st_mtime_ns for p in Path(place).rglob("part-*")}


def ranged(spark, place, n_files, partition_by=()):
    """Ids 0 to 19 in the first file, 20 to 39 in the second, and so on."""
    df = spark.range(0, 20 * n_files, numPartitions=n_files).select("id", F.concat(F.lit("v"), "id").alias("name"), (F.col("id") % 2).cast("int").alias("n"))
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(place)
    return {r.id: (r.name, r.n) for r in df.collect()}


def test_changes_of_few_files_leave_the_others(spark, place):
    expected = ranged(spark, place, 60)
    before = files(place)
    changes = [(i, f"new{i}", None) for i in range(45, 75)] + [(9000 + i, "more", 1) for i in range(5)] + [(None, "no key", 2)]
    upsert(spark, spark.createDataFrame(changes, SCHEMA), place, ["id"])
    after = files(place)
    kept = {f for f in before if after.get(f) == before[f]}
    assert len(kept) == 58 and len(before) == 60  # ids 45 to 74 lie in files 2 and 3
    expected |= {i: (name, n) for i, name, n in changes}
    assert rows(spark.read.parquet(place)) == sorted(((i, *v) for i, v in expected.items()), key=repr)
    assert not any("__merge_" in p.name or p.name == "_merges" for p in __import__("pathlib").Path(place).parent.rglob("*"))


@pytest.mark.parametrize("limit", [layers.sizes.BROADCAST_BYTES, 0])
def test_only_new_keys_rewrite_nothing(spark, place, monkeypatch, limit):
    monkeypatch.setattr(layers.sizes, "BROADCAST_BYTES", limit)
    ranged(spark, place, 10)
    before = files(place)
    upsert(spark, spark.createDataFrame([(-1, "a", 1), (-2, "b", 2)], SCHEMA), place, ["id"])
    after = files(place)
    assert all(after[f] == t for f, t in before.items())
    assert spark.read.parquet(place).count() == 202


def test_changes_in_most_files_replace_the_table(spark, place):
    expected = ranged(spark, place, 8)
    before = files(place)
    changes = [(20 * k, "first", 0) for k in range(5)]
    upsert(spark, spark.createDataFrame(changes, SCHEMA), place, ["id"])
    assert not set(files(place)) & set(before)
    expected |= {i: (name, n) for i, name, n in changes}
    assert rows(spark.read.parquet(place)) == sorted(((i, *v) for i, v in expected.items()), key=repr)


def test_partitions_that_are_no_key_are_kept(spark, place):
    """A changed row may move to another partition folder."""
    expected = ranged(spark, place, 10, ["n"])
    before = files(place)
    upsert(spark, spark.createDataFrame([(21, "moved", 7), (23, "same", 1), (777, "new", 0)], SCHEMA), place, ["id"])
    expected |= {21: ("moved", 7), 23: ("same", 1), 777: ("new", 0)}
    got = spark.read.parquet(place).select("id", "name", "n")
    assert rows(got) == sorted(((i, *v) for i, v in expected.items()), key=repr)
    assert len(set(files(place)) & set(before)) == 19


def test_folders_with_blanks_and_signs(spark, tmp_path):
    place = str(tmp_path / "a table, 50% = half")
    ranged(spark, place, 10)
    spark.read.parquet(place).withColumn("day", F.concat(F.lit("d:"), F.floor(F.col("id") / 100), F.lit(" x%"))).write.partitionBy("day").parquet(place + "2")
    upsert(spark, spark.createDataFrame([(5, "five", 5)], SCHEMA), place, ["id"])
    got = {r.id: r.name for r in spark.read.parquet(place).collect()}
    assert got[5] == "five" and len(got) == 200
    upsert(spark, spark.createDataFrame([(5, "five", 5, "d:0 x%")], SCHEMA + ", day string"), place + "2", ["id"])
    again = {(r.id, r.name, r.day) for r in spark.read.parquet(place + "2").collect()}
    assert (5, "five", "d:0 x%") in again and len(again) == 200


def test_a_merge_cut_off_before_its_journal_changes_nothing(spark, place, monkeypatch):
    ranged(spark, place, 10)
    before = files(place)
    monkeypatch.setattr(layers, "overwrite", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
    with pytest.raises(OSError):
        upsert(spark, spark.createDataFrame([(5, "five", 5)], SCHEMA), place, ["id"])
    assert files(place) == before


def test_a_merge_cut_off_after_its_journal_is_finished_by_the_next(spark, place, monkeypatch):
    expected = ranged(spark, place, 10)
    real, calls = layers.finish_merges, []

    def cut_off(session, location):
        calls.append(location)
        return real(session, location) if len(calls) != 2 else 0

    monkeypatch.setattr(layers, "finish_merges", cut_off)
    upsert(spark, spark.createDataFrame([(5, "five", 5)], SCHEMA), place, ["id"])
    assert rows(spark.read.parquet(place)) == sorted(((i, *v) for i, v in expected.items()), key=repr)
    upsert(spark, spark.createDataFrame([(6, "six", 6)], SCHEMA), place, ["id"])
    expected |= {5: ("five", 5), 6: ("six", 6)}
    assert rows(spark.read.parquet(place)) == sorted(((i, *v) for i, v in expected.items()), key=repr)
    assert finish_merges(spark, place) == 0


def test_overwrite_after_a_merge(spark, place):
    ranged(spark, place, 10)
    upsert(spark, spark.createDataFrame([(5, "five", 5)], SCHEMA), place, ["id"])
    overwrite(spark.range(3), place)
    assert spark.read.parquet(place).count() == 3

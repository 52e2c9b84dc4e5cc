"""Uniqueness from counts that are kept per folder."""

from __future__ import annotations

import glob
import os

import pytest

from dqgate.operators.uniqueness import uniqueness_stats
from dqgate.sinks import key_store
from dqgate.sinks.key_store import folder_states, kept_key_counts, kept_uniqueness_stats, refresh_keys
from dqgate.sinks.layers import append, overwrite, remove_path
from dqgate.sources.files import read_path
from tests.conftest import rows

LONG = "x" * 40


def put(spark, place, values, mode=append):
    mode(spark.createDataFrame(values, "day string, id int, name string, v double"), place, partition_by=["day"])


def agrees(spark, place, keys, store):
    found = rows(kept_uniqueness_stats(spark, place, keys, store))
    assert found == rows(uniqueness_stats(read_path(spark, place), keys))
    return found[0]


def garble(path):
    """Replace a file's pages, so that reading them fails, but neither its footer, size nor time."""
    stat = os.stat(path)
    with open(path, "rb+") as file:
        file.seek(-8, os.SEEK_END)
        footer = int.from_bytes(file.read(4), "little") + 8
        file.seek(4)
        file.write(b"-" * (stat.st_size - footer - 4))
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    for check in glob.glob(f"{os.path.dirname(path)}/.*.crc"):
        os.remove(check)


def test_a_later_run_reads_only_new_folders_and_finds_repeats_across(spark, place, tmp_path):
    store = str(tmp_path / "store")
    put(spark, place, [("a", 1, LONG, 0.0), ("a", 2, None, 1.0), ("b/ c%", 3, "n", 1.0)])
    assert agrees(spark, place, ["id"], store) == (0, 0)
    assert refresh_keys(spark, place, ["id"], store) == []
    put(spark, place, [("d", 1, LONG, -0.0), ("d", 4, "n", 1.0), ("d", 4, "n", 1.0), ("d", None, None, None)])
    assert agrees(spark, place, ["id"], store) == (4, 2)
    put(spark, place, [("e", 2, "n", 2.0)])
    for old in glob.glob(f"{place}/day=[abd]*/*.parquet"):
        garble(old)
    spark.catalog.refreshByPath(place)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        rows(uniqueness_stats(read_path(spark, place), ["id"]))
    assert [os.path.basename(f) for f in refresh_keys(spark, place, ["id"], store)] == ["day=e"]
    assert rows(key_store.counted_stats(kept_key_counts(spark, place, ["id"], store))) == [(6, 3)]


def test_only_folders_of_the_plan_are_scanned(spark, place, tmp_path):
    store = str(tmp_path / "store")
    put(spark, place, [("a", 1, "n", 0.0)])
    refresh_keys(spark, place, ["id"], store)
    plan = kept_key_counts(spark, place, ["id"], store)
    assert not [f for f in plan.inputFiles() if place in f] and [f for f in plan.inputFiles() if store in f]


@pytest.mark.parametrize("keys", [["name"], ["id", "name"], ["day", "v"], ["ID"]])
def test_keys_of_all_kinds(spark, place, tmp_path, keys):
    store = str(tmp_path / "store")
    put(spark, place, [("a", 1, LONG, 0.0), ("a", None, LONG, float("nan")), ("a", None, None, None), ("1", 1, "", -0.0)])
    agrees(spark, place, keys, store)
    put(spark, place, [("a", 1, LONG, -0.0), ("a", 2, LONG[:-1], float("nan")), ("1", None, "", 0.0)])
    agrees(spark, place, keys, store)


def test_changed_and_vanished_folders(spark, place, tmp_path):
    store = str(tmp_path / "store")
    put(spark, place, [("a", 1, "n", 0.0), ("b", 1, "n", 0.0), ("c", 1, "n", 0.0)])
    assert agrees(spark, place, ["id"], store) == (3, 1)
    remove_path(spark, f"{place}/day=b")
    assert agrees(spark, place, ["id"], store) == (2, 1)
    spark.createDataFrame([(None, "n", 0.0)], "id int, name string, v double").write.mode("overwrite").parquet(f"{place}/day=a")
    spark.catalog.refreshByPath(place)
    assert agrees(spark, place, ["id"], store) == (0, 0)
    assert len(glob.glob(f"{store}/*/counts/folder_id=*")) == 1
    put(spark, place, [("z", 7, "n", 0.0)] * 2, overwrite)
    assert agrees(spark, place, ["id"], store) == (2, 1)


def test_a_run_cut_off_before_its_note_counts_again(spark, place, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    put(spark, place, [("a", 1, "n", 0.0)])
    refresh_keys(spark, place, ["id"], store)
    put(spark, place, [("b", 1, "n", 0.0)])
    with monkeypatch.context() as patch:
        patch.setattr(key_store, "_note", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            refresh_keys(spark, place, ["id"], store)
    assert rows(kept_key_counts(spark, place, ["id"], store).select("n_rows")) == [(1,)]
    assert agrees(spark, place, ["id"], store) == (2, 1)


def test_tables_without_folders_or_rows(spark, place, tmp_path):
    store = str(tmp_path / "store")
    overwrite(spark.createDataFrame([], "id int, n_rows int, folder string"), place)
    assert agrees(spark, place, ["id"], store) == (0, 0)
    append(spark.createDataFrame([(1, 1, "f"), (1, 2, "f"), (2, 3, "f")], "id int, n_rows int, folder string"), place)
    assert agrees(spark, place, ["id"], store) == (2, 1)
    assert agrees(spark, place, ["n_rows", "folder"], store) == (0, 0)
    assert len(folder_states(spark, place).collect()) == 1

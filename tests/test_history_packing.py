"""Compaction of the audit history."""

from __future__ import annotations

import datetime as dt
import glob

import pytest

from dqgate.schemas import AUDIT_SCHEMA
from dqgate.sinks import history
from tests.conftest import rows

DAYS = [dt.datetime(2024, 1, 5, 3), dt.datetime(2024, 1, 6, 9)]


def put(spark, place, run, job, days=DAYS):
    made = [tuple(day if f.name == "CRTD_TM" else job if f.name == "JOB_ID" else None for f in AUDIT_SCHEMA) for day in days]
    history.append_history(spark.createDataFrame(made, AUDIT_SCHEMA), place, run)


def jobs(spark, place):
    read = history.read_history(spark, place)
    assert read.columns == AUDIT_SCHEMA.names
    return sorted((r.CRTD_TM.day, r.JOB_ID) for r in read.collect())


def files(place):
    return glob.glob(f"{place}/*/*/*.parquet")


def test_packs_keep_rows_and_reruns_replace_their_own(spark, place):
    for i in range(4):
        put(spark, place, f"run {i}", i)
    put(spark, place, None, 9, DAYS[:1])
    before = rows(history.read_history(spark, place))
    assert history.compact_history(spark, place, 5) == ["2024-01-05"]
    assert rows(history.read_history(spark, place)) == before and len(files(place)) == 1 + 4
    put(spark, place, "run 1", 100)
    expected = sorted([(d, j) for d in (5, 6) for j in (0, 100, 2, 3)] + [(5, 9)])
    assert jobs(spark, place) == expected
    assert history.compact_history(spark, place, 1) == ["2024-01-05", "2024-01-06"]
    assert jobs(spark, place) == expected and len(files(place)) == 2
    assert history.compact_history(spark, place, 1) == []
    put(spark, place, "run 1", 200, DAYS[1:])
    assert (5, 100) in jobs(spark, place) and (6, 200) in jobs(spark, place) and (6, 100) not in jobs(spark, place)
    history.purge_history(spark, place, dt.datetime(2024, 1, 6, 5), days=0)
    assert jobs(spark, place) == [(6, 0), (6, 2), (6, 3), (6, 200)]


@pytest.mark.parametrize("done", [0, 1, 2])
def test_a_compaction_cut_off_changes_no_row(spark, place, monkeypatch, done):
    """Cut off before the pack is in place, or before all or some of the packed folders have left."""
    for i in range(2):
        put(spark, place, f"run {i}", i, DAYS[:1] * 40)
    before, real, moved = jobs(spark, place), history.move, []

    def cut(*names):
        if len(moved) == done:
            raise KeyboardInterrupt
        moved.append(names)
        real(*names)

    with monkeypatch.context() as patch:
        patch.setattr(history, "move", cut)
        with pytest.raises(KeyboardInterrupt):
            history.compact_history(spark, place, 1)
    spark.catalog.refreshByPath(place)
    assert jobs(spark, place) == before
    assert history.compact_history(spark, place, 1) == ["2024-01-05"]
    assert jobs(spark, place) == before and len(files(place)) == 1

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqgate.functions.threshold import pair_status, pct_change, rerun_status
from dqgate.operators.compare import compared, paired

BOUNDARIES = [
    # previous, current, percent, status of a pair, status of a rerun
    (100, 120, 20, "Pass", "Pass"),
    (100, 121, 21, "Fail", "Fail"),
    (100, 95, -5, "Pass", "Pass"),
    (100, 94, -6, "Fail", "Fail"),
    (1000, 1209, 20, "Pass", "Pass"),
    (1000, 1210, 21, "Fail", "Fail"),
    (1000, 941, -5, "Pass", "Pass"),
    (1000, 940, -6, "Fail", "Fail"),
    (100, 129, 28, "Fail", "Fail"),
    (0, 0, None, "Pass", "Fail"),
    (0, 5, None, "Fail", "Pass"),
    (None, 5, None, "Fail", "Pass"),
    (None, 0, None, "Fail", "Fail"),
    (5, None, None, "Fail", "Fail"),
    (None, None, None, "Fail", "Fail"),
    (1, 10**18, None, "Fail", "Fail"),
]


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,6)", "double"])
def test_boundaries(spark, kind):
    df = spark.createDataFrame([(i, b[0], b[1]) for i, b in enumerate(BOUNDARIES)], "i int, p bigint, c bigint")
    df = df.select("i", F.col("p").cast(kind).alias("p"), F.col("c").cast(kind).alias("c"))
    got = df.select("i", pct_change("p", "c"), pair_status("p", "c"), rerun_status("p", "c")).collect()
    for i, pct, pair, rerun in got:
        expected = BOUNDARIES[i]
        if expected[2] is not None:
            assert pct == expected[2], expected
        assert (pair, rerun) == expected[3:], expected


def test_fractions_are_dropped_before_comparing(spark):
    df = spark.sql("SELECT CAST(100.9 AS decimal(38,6)) AS p, CAST(120.9 AS decimal(38,6)) AS c")
    assert tuple(df.select(pct_change("p", "c"), pair_status("p", "c")).first()) == (20, "Pass")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**6), st.integers(0, 10**6)), min_size=1, max_size=50))
def test_rule_agrees_with_its_definition(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p bigint, c bigint")
    for i, pct, status in compared(df, "p", "c", "pair").select("i", "pct_change", "status").collect():
        previous, current = pairs[i]
        expected = int(((current - previous) / previous) * 100)
        assert pct == expected
        assert status == ("Fail" if expected > 20 or expected < -5 else "Pass")


def test_paired_keeps_checks_of_either_side(spark):
    src = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    dst = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v bigint")
    got = {r["k"]: (r["source_result"], r["destination_result"]) for r in paired(src, dst, "k", "v").collect()}
    assert got == {"a": (1, None), "b": (2, 3), "c": (None, 4)}

"""Metrics, uniqueness and foreign keys against small tables and brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqgate.functions import keys, sizes
from dqgate.operators import referential, uniqueness
from dqgate.operators.kpi import kpi_agg, kpi_sql
from dqgate.operators.metrics import Metric, table_metrics
from dqgate.plans.run import union_all
from tests.conftest import rows

SMALL = st.one_of(st.none(), st.integers(0, 6))


def _metrics(df, *metrics):
    return {(r.check_id, r.side): r for r in union_all(table_metrics(df, metrics)).collect()}


def test_metrics_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, t timestamp")
    got = _metrics(df, Metric(0, "nulls", "a"), Metric(1, "latest", "t"), Metric(2, "rows"))
    assert got[0, "main"].unexpected_rows == 0
    assert got[1, "main"].as_of_max is None
    assert got[2, "main"].total_rows == 0


def test_unexpected_values_are_compared_in_the_columns_type(spark):
    df = spark.createDataFrame([(1, "1"), (2, "x"), (None, None)], "n bigint, s string")
    got = _metrics(
        df,
        Metric(0, "in_list", "n", ("1", "x", "2.5")),
        Metric(1, "in_list", "s", ("x", "1")),
        Metric(2, "in_list", "n", ()),
        Metric(3, "in_list", "n", ("x",)),
    )
    assert [got[i, "main"].unexpected_rows for i in range(4)] == [1, 2, 0, 0]


def test_many_metrics_take_several_passes(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    wanted = [Metric(i, "nulls", "ab"[i % 2]) for i in range(130)]
    frames = table_metrics(df, wanted)
    assert len(frames) == 3
    got = {r.check_id: r.unexpected_rows for r in union_all(frames).collect()}
    assert got == {i: i % 2 for i in range(130)}


@pytest.mark.parametrize(
    ("function", "column", "expected"),
    [
        ("SUM", "n", 9.0),
        ("count", "*", 3.0),
        ("count", "s", 2.0),
        ("AVG", "n", 4.5),
        ("min", "n", 3.0),
        ("max", "d", 2.25),
        ("count_distinct", "n", 2.0),
        ("approx_count_distinct", "n", 2.0),
        ("sum", "s", 7.0),
        ("max", "s", None),
        ("median", "n", 4.5),
        ("SUM", "n * 2", 18.0),
        ("sum", "DISTINCT n", 9.0),
        ("bool_and", "n > 1", None),
        ("stddev_pop", "n", 1.5),
        ("count_distinct", "n % 3", 1.0),
    ],
)
def test_kpi_aggregates(spark, function, column, expected):
    df = spark.createDataFrame([(3, "7", 2.25), (6, "x", 1.0), (None, None, None)], "n bigint, s string, d double")
    value = kpi_agg(df, function, column).first()[0]
    assert (None if value is None else float(value)) == expected


def test_kpi_sum_does_not_overflow(spark):
    df = spark.range(4).select(F.lit(2**62).alias("n"))
    assert int(kpi_agg(df, "sum", "n").first()[0]) == 2**64


def test_kpi_aggregate_names_are_limited(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="no name of an aggregate"):
        kpi_agg(df, "max(id) --", "id")
    with pytest.raises(ValueError, match="numeric column"):
        kpi_agg(df.select(F.current_date().alias("d")), "sum", "d")


def test_kpi_sql_takes_the_first_column(spark):
    assert float(kpi_sql(spark, "SELECT 2.5 AS a, 'x' AS b").first()[0]) == 2.5
    assert kpi_sql(spark, "SELECT max(id) FROM range(0)").first()[0] is None


# ---- uniqueness ------------------------------------------------------------


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(SMALL, SMALL), max_size=40))
def test_uniqueness_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    for names in (["a"], ["a", "b"]):
        parts = [tuple(r[: len(names)]) for r in data]
        counts = Counter(p for p in parts if any(x is not None for x in p))
        repeated = [c for c in counts.values() if c > 1]
        got = uniqueness.uniqueness_stats(df, names).first()
        assert (got.unexpected_rows, got.unexpected_keys) == (sum(repeated), len(repeated))


def test_long_texts_are_compared_whole(spark):
    long = "x" * 5000
    data = [(long + "a",), (long + "b",), (long + "a",), ("x" * 31,), ("x" * 32,), ("x" * 31,), ("",), ("",)]
    df = spark.createDataFrame(data, "t string")
    got = uniqueness.uniqueness_stats(df, ["t"]).first()
    assert (got.unexpected_rows, got.unexpected_keys) == (6, 3)
    assert df.select(F.max(F.octet_length(keys.compact_key(df, "t")))).first()[0] == 32


def test_a_text_equal_to_a_digest_is_another_key(spark):
    digest = spark.range(1).select(F.sha2(F.lit("y" * 40), 256)).first()[0]
    df = spark.createDataFrame([("y" * 40,), (digest,)], "t string")
    assert uniqueness.uniqueness_stats(df, ["t"]).first().unexpected_rows == 0


def test_repeated_keys_show_their_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (None, None), (None, None)], "k int, v string")
    assert rows(uniqueness.repeated_keys(df, ["k", "v"])) == [(1, "a", 2), (1, None, 2)]


def test_one_hot_key_leaves_each_task_as_one_row(spark):
    df = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k")
    )
    got = uniqueness.uniqueness_stats(df, ["k"]).first()
    assert (got.unexpected_rows, got.unexpected_keys) == (10001, 1)
    plan = uniqueness.key_counts(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")


# ---- foreign keys ----------------------------------------------------------


@settings(max_examples=12, deadline=None)
@given(st.lists(SMALL, max_size=30), st.lists(SMALL, max_size=8))
def test_foreign_key_parts_add_up(spark, fact_keys, dim_keys):
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(fact_keys)], "i int, k int")
    dim = spark.createDataFrame([(k,) for k in dim_keys], "d bigint")
    known = {k for k in dim_keys if k is not None}
    orphans = [k for k in fact_keys if k is not None and k not in known]
    stats = referential.foreign_key_stats(fact, "k", dim, "d").first()
    assert (stats.unexpected_rows, stats.unexpected_keys) == (len(orphans), len(set(orphans)))
    bad = rows(referential.orphan_rows(fact, "k", dim, "d"))
    good = rows(referential.valid_rows(fact, "k", dim, "d"))
    assert sorted(k for _, k in bad) == sorted(orphans)
    assert len(bad) + len(good) + fact_keys.count(None) == len(fact_keys)


def test_large_dimension_path_gives_the_same_rows(spark, monkeypatch):
    """Hot and cold keys are joined in two ways; together they are the plain join."""
    fact = spark.range(0, 20000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7)  # in the dimension, a third of all rows
        .when(F.col("id") % 3 == 1, -1)  # not in it, another third
        .when(F.col("id") % 50 == 0, None)
        .otherwise(F.col("id"))
        .alias("k"),
    )
    dim = spark.range(0, 10000).select(F.col("id").alias("d")).union(spark.range(7, 8))
    plain_bad = rows(fact.where("k IS NOT NULL").join(dim, fact.k == dim.d, "left_anti"))
    plain_good = rows(fact.join(dim, fact.k == dim.d, "left_semi"))
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", -1)
    assert rows(referential.orphan_rows(fact, "k", dim, "d")) == plain_bad
    assert rows(referential.valid_rows(fact, "k", dim, "d")) == plain_good


def test_the_fact_is_scanned_once_and_its_hot_key_split(spark, monkeypatch, tmp_path):
    spark.range(0, 300_000, numPartitions=4).selectExpr("id", "if(id % 3 > 0, 7, id) AS k").write.parquet(f"{tmp_path}/fact")
    spark.range(0, 100_000).selectExpr("id AS d").write.parquet(f"{tmp_path}/dim")
    fact, dim = spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/dim")
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", -1)
    settings = {"advisoryPartitionSizeInBytes": "64k", "skewJoin.skewedPartitionThresholdInBytes": "64k", "coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(f"spark.sql.adaptive.{key}", value)
    try:
        for how, n in ((referential.orphan_rows, 66_666), (referential.valid_rows, 233_334)):
            found = how(fact, "k", dim, "d")
            assert found.columns == ["id", "k"] and found.count() == n
            found.collect()
            plan = found._jdf.queryExecution().executedPlan().toString()
            final = plan[: plan.index("Initial Plan")]
            assert "skew=true" in final and final.count("/fact]") == 1
    finally:
        for key in settings:
            spark.conf.unset(f"spark.sql.adaptive.{key}")


def test_a_dimension_is_broadcast_by_its_distinct_keys(spark, monkeypatch):
    dim = spark.range(0, 5000).selectExpr("id % 10 AS d")
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", 1000)
    got = referential.valid_rows(spark.range(5, 15).selectExpr("id AS k"), "k", dim, "d")
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == [(i,) for i in range(5, 10)]


def test_large_dimension_path_with_text_keys(spark, monkeypatch):
    fact = spark.range(0, 5000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k")
    )
    dim = spark.range(0, 2500).select(F.concat(F.lit("k"), "id").alias("d"))
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", -1)
    bad = referential.orphan_rows(fact, "k", dim, "d")
    good = referential.valid_rows(fact, "k", dim, "d")
    assert (bad.count(), good.count()) == (1667 + 1667, 1666)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(9,2)", "double", "binary", "boolean"])
def test_large_dimension_path_with_other_types(spark, monkeypatch, kind):
    text = "concat('2024-01-0', id)" if kind.startswith(("date", "time")) else "string(id)"
    if kind == "boolean":
        text = "string(id < 3)"
    fact = spark.range(1, 7).selectExpr("id", f"CAST({text} AS {kind}) AS k")
    dim = spark.range(1, 3).selectExpr(f"CAST({text} AS {kind}) AS d")
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", -1)
    assert sorted(r.id for r in referential.valid_rows(fact, "k", dim, "d").collect()) == [1, 2]
    assert sorted(r.id for r in referential.orphan_rows(fact, "k", dim, "d").collect()) == [3, 4, 5, 6]


@pytest.mark.parametrize(("left", "right"), [("int", "bigint"), ("bigint", "double"), ("decimal(9,2)", "int"), ("string", "int")])
def test_keys_of_two_types(spark, left, right):
    fact = spark.range(1, 4).selectExpr("id", f"CAST(id AS {left}) AS k")
    dim = spark.range(1, 3).selectExpr(f"CAST(id AS {right}) AS d")
    assert [tuple(r) for r in referential.missing_keys(fact, "k", dim, "d").selectExpr("int(missing_key)", "n_rows").collect()] == [(3, 1)]
    assert [r.id for r in referential.orphan_rows(fact, "k", dim, "d").collect()] == [3]


def test_keys_of_different_types_still_match(spark):
    fact = spark.createDataFrame([("1",), ("2",), ("x",)], "k string")
    dim = spark.createDataFrame([(1,), (2,)], "d bigint")
    stats = referential.foreign_key_stats(fact, "k", dim, "d").first()
    assert (stats.unexpected_rows, stats.unexpected_keys) == (1, 1)


def test_fact_keys_are_counted_before_a_shuffled_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(0, 1000).select((F.col("id") % 10).alias("k"))
        dim = spark.range(0, 500).select(F.col("id").alias("d"))
        plan = referential.missing_keys(fact, "k", dim, "d")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("SortMergeJoin")
    assert plan.index("partial_count") > join
    assert plan.count("Exchange hashpartitioning") == 2  # the join reuses the count's partitioning

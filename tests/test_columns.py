from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqgate.functions import columns, formatting
from tests.conftest import rows


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("Order ID", "order_id"),
        ("A  B|C", "a_b_c"),
        ("naïve col", "na_ve_col"),
        ("Price ($)", "price_($)"),
        ("__x__", "_x_"),
        (" x ", "x"),
        ("a.b/c\\d", "a.b/c\\d"),
        ("[x]-{y}", "[x]-{y}"),
        ("|", ""),
    ],
)
def test_normalize_name(name, expected):
    assert columns.normalize_name(name) == expected


@given(st.text(max_size=30))
def test_normalized_names_hold_no_blanks_or_bars(name):
    normalized = columns.normalize_name(name)
    assert not set(normalized) & set(" |\t\n")


def test_normalize_name_text_agrees_with_python(spark):
    names = ["Order ID", "A  B|C", "naïve col", "Price ($)", "__x__", "a\tb", '"q";\'z\'']
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(columns.normalize_name_text(F.col("name"))).collect()]
    assert got == [columns.normalize_name(n) for n in names]


def test_normalize_columns_rejects_a_clash(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a|b"])
    with pytest.raises(ValueError, match="a_b"):
        columns.normalize_columns(df)


def test_columns_with_dots_and_ticks(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["z", "a.b", "c`d"])
    assert columns.cols_to_front(df, ["z"]).columns == ["z", "a.b", "c`d"]
    assert columns.cols_to_front(df, ["c`d"]).first()[0] == 3


def test_resolve_ignores_case_and_raises(spark):
    df = spark.createDataFrame([(1,)], ["Id"])
    assert columns.resolve(df, "ID") == "Id"
    with pytest.raises(ValueError, match="no column"):
        columns.resolve(df, "other")


def test_first_value_and_distinct(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "a")], "k int, v string")
    assert columns.first_value(df, "v", "k").first()[0] == "a"
    assert rows(columns.distinct_values(df, "v")) == [("a",), ("c",)]


def test_column_list_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "a")], "k int, v string")
    assert [r.value for r in columns.column_list(df, "v", "k").collect()] == ["a", "a", "c"]


def test_a_long_column_list_is_whole(spark):
    df = spark.range(150_000).select("id", (F.col("id") * 2).alias("v"))
    listed = columns.column_list(df, "v", "id")
    assert listed.count() == 150_000
    assert listed.where("value <> 2 * position").isEmpty()


@pytest.mark.parametrize(
    "items",
    [["X", "Z"], ["it's"], ['say "x"'], ["it's \"x\""], ["back\\slash"], ["9-NONE"], []],
)
def test_list_text_is_how_a_list_is_printed(spark, items):
    df = spark.createDataFrame([(items,)], "items array<string>")
    assert df.select(formatting.list_text(F.col("items"))).first()[0] == str(items)[1:-1]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("1234567", "1,234,567"),
        ("3758439620.06", "3,758,439,620.06"),
        ("0.5", "0.5"),
        ("-0.5", "-0.5"),
        ("-1234.5", "-1,234.5"),
        ("0", "0"),
        ("10.10", "10.1"),
    ],
)
def test_number_text(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string").select(F.col("v").cast("decimal(38,6)"))
    shown = df.select(formatting.number_text(F.col("v"))).first()[0]
    assert shown == expected
    back = spark.createDataFrame([(shown,)], "v string")
    assert float(back.select(formatting.plain_number(F.col("v"))).first()[0]) == float(value)


def test_validated_on(spark):
    df = spark.sql("SELECT timestamp '2024-01-31 06:05:59' AS ts")
    assert df.select(formatting.validated_on(F.col("ts"))).first()[0] == "01-31-2024 06:05"

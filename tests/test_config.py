from __future__ import annotations

import pytest

from dqgate import names as n
from dqgate.plans import checks
from dqgate.schemas import CONFIG_COLUMNS, CONFIG_SCHEMA
from dqgate.sources.config_csv import read_check_config


def config(spark, *entries):
    base = {"PipelineName": "P", "StageName": n.STAGE_BRONZE, "Check_Status": "yes"}
    return spark.createDataFrame(
        [tuple({**base, **e}.get(c) for c in CONFIG_COLUMNS) for e in entries], CONFIG_SCHEMA
    )


def items(spark, *entries):
    return checks.check_items(config(spark, *entries)).orderBy("item_pos").collect()


def test_csv_with_quotes_newlines_and_delimiters(spark, tmp_path):
    header = ",".join(CONFIG_COLUMNS)
    values = {c: "" for c in CONFIG_COLUMNS}
    values.update(
        PipelineName="P",
        columns_list='"a,b,,c"',
        SourceQuery='"SELECT ""x"",\n 1 FROM t"',
        IsStageDependency="1",
    )
    path = tmp_path / "checks.csv"
    path.write_text(header + "\n" + ",".join(values[c] for c in CONFIG_COLUMNS) + "\n")
    row = read_check_config(spark, str(path)).first()
    assert (row.columns_list, row.SourceQuery) == ("a,b,,c", 'SELECT "x",\n 1 FROM t')
    assert row.IsStageDependency == "1" and row.SLAThreshold is None


def test_csv_with_another_delimiter(spark, tmp_path):
    path = tmp_path / "checks.csv"
    path.write_text(";".join(CONFIG_COLUMNS) + "\n" + ";".join(["a,b"] + ["x"] * 22) + "\n")
    assert read_check_config(spark, str(path), ";").first().PipelineName == "a,b"


def test_only_exact_yes_is_active(spark):
    df = config(spark, {}, {"Check_Status": "Yes"}, {"Check_Status": "no"}, {"Check_Status": None})
    assert checks.active_checks(df).count() == 1
    assert checks.active_checks(df, pipeline="Q").count() == 0


@pytest.mark.parametrize(
    ("stage", "check", "family"),
    [
        (n.STAGE_BRONZE, n.ROW_COUNT, n.FAMILY_ROW_COUNT),
        (n.STAGE_SYNAPSE, n.SOURCE_DESTINATION, n.FAMILY_ROW_COUNT),
        (n.STAGE_GOLD, n.NULL, n.FAMILY_QUALITY),
        (n.STAGE_PRE_POST, n.PRE_POST, n.FAMILY_PRE_POST),
        (n.STAGE_PRE_POST, n.ROW_COUNT, n.FAMILY_PRE_POST),
        (n.STAGE_KPI, n.SOURCE_DESTINATION, n.FAMILY_KPI),
    ],
)
def test_routing(spark, stage, check, family):
    df = checks.routed(config(spark, {"StageName": stage, "ValidationCheck": check}))
    assert df.first().family == family


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a,b", [["a", "b"]]),
        ("A,B,,C", [["A", "B"], ["C"]]),
        ('[["a","b"],["c,d",""]]', [["a", "b"], ["c,d", ""]]),
        (None, None),
    ],
)
def test_groups(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(checks.groups_of("t")).first()[0] == expected


def test_table_parts(spark):
    df = spark.createDataFrame([("A,B,,C,,,D",)], "t string")
    assert df.select(checks.tables_of("t")).first()[0] == ["A,B,,C", "D"]


def test_null_check_has_one_item_per_column(spark):
    got = items(spark, {"ValidationCheck": n.NULL, "columns_list": "a, b", "IsStageDependency": "1"})
    assert [(i.columns, i.on_stage_depend) for i in got] == [(["a"], 1), (["b"], 1)]


def test_json_lists_allow_commas_and_empty_values(spark):
    got = items(
        spark,
        {"ValidationCheck": n.UNEXPECTED, "columns_list": '["a"]', "unexpected_list": '[["x,y",""]]'},
    )
    assert got[0].unexpected_values == ["x,y", ""]


def test_foreign_keys_pair_tables_and_columns(spark):
    got = items(
        spark,
        {
            "ValidationCheck": n.FOREIGN_KEY,
            "SourceTableName": "f1,f2",
            "SourceTableLocation": "/f1,/f2",
            "DestinationTableName": "d1,d2",
            "DestinationTableLocation": "/d1,/d2",
            "columns_list": "k,a->b",
        },
    )
    assert [(i.src_table, i.src_location, i.table_name, i.location, i.columns, i.dest_column) for i in got] == [
        ("f1", "/f1", "d1", "/d1", ["k"], "k"),
        ("f2", "/f2", "d2", "/d2", ["a"], "b"),
    ]


@pytest.mark.parametrize(
    ("entry", "message"),
    [
        ({"ValidationCheck": "Typo"}, "unknown check: Typo"),
        ({"ValidationCheck": n.NULL}, "columns_list is empty"),
        ({"ValidationCheck": n.NULL, "columns_list": "  "}, "columns_list is empty"),
        (
            {"ValidationCheck": n.UNEXPECTED, "columns_list": "a,b", "unexpected_list": "X"},
            "columns_list and unexpected_list differ in length",
        ),
        (
            {"ValidationCheck": n.UNEXPECTED, "columns_list": "a"},
            "columns_list and unexpected_list differ in length",
        ),
        (
            {"ValidationCheck": n.FOREIGN_KEY, "columns_list": "a,b", "SourceTableName": "f",
             "DestinationTableName": "d", "SourceTableLocation": "f", "DestinationTableLocation": "d"},
            "foreign key tables, locations and columns differ in length",
        ),
        ({"ValidationCheck": n.SLA, "columns_list": "t", "SLAThreshold": "soon"}, "SLAThreshold is not a number"),
        ({"ValidationCheck": n.SLA, "columns_list": "t"}, "SLAThreshold is not a number"),
        ({"StageName": n.STAGE_KPI, "ValidationCheck": n.NULL}, "unknown check: NullCheck"),
    ],
)
def test_unusable_rows_say_why(spark, entry, message):
    (item,) = items(spark, entry)
    assert item.error == message


def test_missing_parameters_are_null_not_text(spark):
    (item,) = items(spark, {"ValidationCheck": n.ROW_COUNT, "RowCountTableName": "t", "RowCountTableLocation": "/t"})
    assert item.columns is None and item.unexpected_values is None and item.src_table is None
    assert item.on_stage_depend == 0


def test_every_config_row_is_its_own_check(spark):
    entry = {"ValidationCheck": n.NULL, "columns_list": "a", "DestinationTableName": "t"}
    assert len(items(spark, entry, {**entry, "columns_list": "b"}, entry)) == 3


def test_runs_and_slices(spark):
    df = config(spark, {}, {"StageName": n.STAGE_GOLD}, {"StageName": n.STAGE_GOLD}, {"Check_Status": "no", "PipelineName": "Q"})
    assert sorted(map(tuple, checks.runs_of(df).collect())) == [("P", n.STAGE_BRONZE), ("P", n.STAGE_GOLD)]
    assert checks.slice_of(df, StageName=n.STAGE_GOLD, PipelineName="P").count() == 2


def test_config_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "named.csv"
    path.write_text("Extra,validationcheck,Check_Status,StageName,PipelineName\n1,RowCount,yes,S,P\n")
    row = read_check_config(spark, str(path)).first()
    assert (row.PipelineName, row.ValidationCheck, row.UniqueID) == ("P", "RowCount", None)
    (tmp_path / "short.csv").write_text("StageName\nS\n")
    with pytest.raises(ValueError, match="PipelineName"):
        read_check_config(spark, str(tmp_path / "short.csv"))

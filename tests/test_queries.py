"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload import registry
from workload.check_tool import compare, connect


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    ok, note = compare(spark, duck, sf_dir, name, registry.QUERIES[name], registry.ORACLE.get(name))
    assert ok, note


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLE) <= set(entry.oracle_sql())


def test_entry_is_the_full_run(spark):
    df = entry.entry(spark)
    assert df.count() == 44
    assert df.schema == entry.queries()["run_all"](spark, "/root/testdata/sf0.001").schema

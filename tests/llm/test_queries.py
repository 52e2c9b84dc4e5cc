"""Queries of the subpackage against their SQL; the tests of those without SQL are beside this file."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from dqgate.llm.queries import ORACLE, QUERIES
from workload.check_tool import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, sf_dir, name):
    ok, note = compare(spark, connect(sf_dir), sf_dir, name, QUERIES[name], ORACLE[name])
    assert ok, note


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())

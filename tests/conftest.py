from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dqgate.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "dqgate-tests",
        cores=4,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__shuffle__partitions="4",
        # The tables here are tiny: compiling each plan would cost more than running it.
        # The comparison tool and the benchmark run with compiled plans.
        spark__sql__codegen__wholeStage="false",
        # Python-side call sites are only needed when a query fails.
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

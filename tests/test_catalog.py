"""Every registered query against its SQL equivalent, at the smallest scale."""

from __future__ import annotations

import importlib
from pathlib import Path

import pytest

from tidemark.catalog import REGISTRY
from tidemark.oracle import ORACLE

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def tool():
    return importlib.import_module("tools.check_oracle")


@pytest.fixture(scope="module")
def database(tool):
    return tool.connect(str(FOLDER))


def test_every_query_has_an_equivalent():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, tool, database, name):
    df = REGISTRY[name](spark, str(FOLDER))
    cursor = database.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert tool.bag(df.columns, map(tuple, df.collect())) == tool.bag(columns, cursor.fetchall())

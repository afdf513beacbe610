"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, _, note = check.compare(spark, con, FOLDER, QUERIES[name], SQL.get(name))
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() == 6

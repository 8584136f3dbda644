"""Every registered query against its SQL check on the smallest data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from check_oracles import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        problem, _ = compare(df, con, sql)
        assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0

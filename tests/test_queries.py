"""Every named query on Spark against its SQL on DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import compare  # noqa: E402

from orderlens.plans import all_queries  # noqa: E402


@pytest.fixture(scope="module")
def con(small):
    return compare.duck(small)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, small, name):
    status, note = compare.check(spark, con, all_queries()[name], small)
    assert status in ("ok", "rows only"), note


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())

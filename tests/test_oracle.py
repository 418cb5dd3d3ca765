"""Every registered query against DuckDB on the sample tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, duck_rows, duck_types, spark_rows, spark_types

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


#: The training-data queries have tests of their own.
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def test_every_query_has_sql():
    assert set(NAMES) <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    sql = entry.oracle_sql()[name]
    df = entry.queries()[name](spark, SF_DIR)
    assert spark_types(df) == duck_types(duck, sql)
    got, expected = spark_rows(df), duck_rows(duck, sql)
    assert len(got) == len(expected)
    assert got == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL counterpart, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF) as connection:
        yield connection


def test_every_panel_query_has_sql():
    from catalog.oracle import ORACLE
    from catalog.queries import QUERIES

    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_entry(spark):
    from annualis.operators import PANEL_COLUMNS

    assert len(PANEL_COLUMNS) == len(set(PANEL_COLUMNS)) == 70
    assert entry.entry(spark).columns == PANEL_COLUMNS

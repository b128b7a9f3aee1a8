"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle_check import compare

import __spark_entry__ as entry
from tagloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    assert compare(spark, FOLDER, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES) <= set(entry.queries())

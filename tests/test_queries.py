"""Registered queries against their SQL twins on the smallest tables."""

from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.catalog.QUERIES))
def test_query(spark, con, name):
    assert compare.compare(spark, con, name, SF_DIR) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["column", "iv", "label", "kind"] and df.count() > 0

"""Every query against its SQL equivalent on the smallest tables."""

import os

import oracle_compare
import pytest

import __spark_entry__ as entry
from coldkeep.checks.oracle import ORACLE
from coldkeep.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle_compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert oracle_compare.compare(df, duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 3

"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest
from oracle import connect, entry, mismatch

from tidemark.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, con, name):
    assert mismatch(spark, con, name, SF_DIR) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0

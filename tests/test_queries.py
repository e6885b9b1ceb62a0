"""Every registered query against its check SQL at the smallest scale."""

import os

import pytest
from check import DATA, compare, duck

from __spark_entry__ import entry
from shiftloom.plans import ORACLES, QUERIES

FOLDER = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    result = compare(spark, con, key, FOLDER, QUERIES, ORACLES)
    assert result.startswith("ok"), result


def test_entry(spark):
    assert entry(spark).count() == 1

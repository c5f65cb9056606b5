"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from stayledger.plans.registry import all_queries

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()
LIBRARY = all_queries()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables are not there")


@pytest.fixture(scope="module")
def tables():
    return connect(str(FOLDER))


def test_every_query_of_the_library_has_a_twin():
    """Training-data operators state their own twins, see tests/llm."""
    assert set(LIBRARY) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, tables, name):
    assert differences(QUERIES[name](spark, str(FOLDER)), tables, ORACLE[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() == 2

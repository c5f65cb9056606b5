"""Bookings of the star tables are decided on narrow rows, without shuffles of their own."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

import pytest

from stayledger.plans.registry import all_queries
from stayledger.plans.star import star_current
from stayledger.plans.warehouse import current_bookings
from stayledger.sources.star import star_history

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not there")


@contextmanager
def large_tables(spark):
    """Joins as they run on tables that are too large for a broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("name", ["booking_metrics", "clean_and_type", "fact_bookings", "warn_invalid_dates"])
def test_current_bookings_are_found_where_the_join_left_them(spark, name):
    with large_tables(spark):
        text = all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in text and "Window" in text
    assert "hashpartitioning(booking_key" not in text
    # one exchange for each side of the four joins
    assert text.count("Exchange hashpartitioning") == 8


@pytest.mark.parametrize("broadcast", [True, False])
def test_current_bookings_are_those_of_the_history(spark, broadcast):
    def compared():
        ours, theirs = star_current(spark, FOLDER), current_bookings(star_history(spark, FOLDER))
        assert ours.schema == theirs.schema
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()

    if broadcast:
        compared()
    else:
        with large_tables(spark):
            compared()

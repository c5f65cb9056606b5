"""Lines are dealt by booking while they are narrow, and merges of dealt rows shuffle nothing wide."""

from __future__ import annotations

from pathlib import Path

import pytest

from rows import history_frame, history_row
from stayledger.operators.incremental import state_of
from stayledger.plans import refresh, registry
from stayledger.plans.star import star_rows_by_booking
from stayledger.plans.warehouse import rows_by_booking
from stayledger.session import new_path
from stayledger.sources.star import star_history
from stayledger.sources.versions import Versions

FOLDER = "/root/testdata/sf0.001"
has_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not there")


@pytest.fixture
def written(spark, monkeypatch):
    """The exchanges in the plans of all bucketed writes, with joins as they run on large tables."""
    seen = []

    def plan(df):
        return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]

    write = Versions.write_bucketed
    monkeypatch.setattr(Versions, "write_bucketed", lambda self, n, parts, *a: seen.append((n, [plan(p) for p in parts])) or write(self, n, parts, *a))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield seen
    spark.conf.set(name, before)


@has_tables
def test_a_merge_of_dealt_deliveries_shuffles_lines_only(spark, written):
    registry._merged(spark, FOLDER, "mart_daily_booking_revenue")
    assert [name for name, _ in written] == ["state", "competing", "state", "competing", "state"]
    for name, parts in written:
        for exchanges in parts:
            # one of narrow lines for the delivery, none for windows, state and bucketed write
            assert len(exchanges) <= 1 and all("REPARTITION_BY_NUM" in e for e in exchanges)
        assert name == "competing" or parts is written[0][1] or not any(parts)


@has_tables
def test_stored_rows_of_dealt_lines_are_those_of_the_history(spark, written):
    ours = star_rows_by_booking(spark, FOLDER)
    by_booking = [e for e in written[0][1][0] if "booking_key" in e]
    # the joined lines are dealt, not the staged rows with their texts
    assert len(by_booking) == 1 and len(written[0][1][0]) == 9
    theirs = rows_by_booking(star_history(spark, FOLDER))
    assert ours.schema == theirs.schema
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_merging_dealt_rows_is_merging(spark, written):
    """Also without keys, with late rows, and when the rows were not dealt after all."""
    old = [history_row(key=k, row=r, batch=f"b{s}", sequence=s, adr=f"{a}.00") for k, r, s, a in [("d:1", 1, 2, 5), ("d:2", 2, 1, 6), ("d:3", 3, 1, 7), (None, 4, 1, 8)]]
    new = [history_row(key=k, row=r, batch=f"b{s}", sequence=s, adr=f"{a}.00") for k, r, s, a in [("d:1", 5, 1, 9), ("d:2", 6, 2, 9), ("d:4", 7, 1, 9), (None, 8, 2, 9)]]
    mart = "mart_hotel_performance"
    store = Versions(spark, new_path(spark, "dealt"))
    for rows in (old, new):
        version, tables = store.current()
        store.commit(refresh.merge_rows(store, tables, history_frame(spark, rows), 4, [mart], dealt=True), on=version)
    found, wanted = store.read("state"), state_of(history_frame(spark, old + new))
    assert found.schema == wanted.schema
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    shown = refresh.open_refreshed(spark, store.root)[mart].first()
    assert (shown["bookings"], float(shown["avg_adr"])) == (5, (5 + 9 + 7 + 9 + 9) / 5)

"""A build moves the wide rows of the history once."""

from __future__ import annotations

from rows import history_frame, history_row
from stayledger.operators.history import current_state, dedupe_exact
from stayledger.plans import warehouse
from stayledger.schema import SOURCE_COLUMNS


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_current_bookings_come_from_stored_rows_without_a_shuffle(spark, monkeypatch):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    written = {}
    store = warehouse.store_bucketed
    monkeypatch.setattr(warehouse, "store_bucketed", lambda n, df, b: written.setdefault(n, _plan(df)) and store(n, df, b))
    try:
        history = history_frame(spark, [history_row(key=f"d:{k}", row=k) for k in range(6)])
        relations = warehouse.build_warehouse(history)
    finally:
        spark.conf.set(threshold, before)
    assert list(written) == ["staged_rows", "current_bookings"]
    assert written["staged_rows"].count("Exchange") == 1
    assert "Exchange" not in written["current_bookings"]
    assert not set(SOURCE_COLUMNS) & set(relations["staged_history"].columns)
    assert relations["current_bookings"].count() == 6


def test_older_batches_of_stored_rows_need_no_shuffle(spark):
    history = history_frame(spark, [history_row(key=f"d:{k}", row=k) for k in range(6)])
    rows = warehouse.rows_by_booking(history)
    assert "Exchange" not in _plan(current_state(dedupe_exact(rows.where("batch_sequence < 3"))))

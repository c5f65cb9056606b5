"""Checks: each kind passes on good rows and counts bad ones."""

from __future__ import annotations

from rows import history_frame, history_row
from stayledger.operators import quality as Q
from stayledger.operators.history import dedupe_exact, current_state, stage
from stayledger.operators.metrics import booking_metrics


def test_declared_counts():
    specs = Q.DECLARED.values()
    assert sum(len(c.not_null) for c in specs) == 48
    assert sum(len(c.unique) for c in specs) == 3
    assert sum(len(c.non_negative) for c in specs) == 8
    assert sum(len(c.accepted) for c in specs) == 1
    assert sum(c.not_empty for c in specs) == 22


def test_check_relation_counts_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, 7), ("b", None)], "k string, n int")
    checks = Q.Checks(not_empty=True, not_null=["k"], unique=["k"], non_negative=["n"], accepted={"n": [1]})
    found = {r.check_name: r.failures for r in Q.check_relation(df, "r", checks).collect()}
    assert found == {"not_null": 1, "non_negative": 1, "accepted_values": 2, "unique": 1, "not_empty": 0}
    empty = {r.check_name: r.failures for r in Q.check_relation(df.where("false"), "r", checks).collect()}
    assert empty == {"not_null": 0, "non_negative": 0, "accepted_values": 0, "unique": 0, "not_empty": 1}


def test_single_checks_return_failing_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, 2)], "k string, n int")
    assert Q.non_negative(df, "n").count() == 1
    assert Q.not_null(df, "k").count() == 1
    assert [r.k for r in Q.unique(df, "k").collect()] == ["a"]
    assert Q.accepted_values(df, "n", [1, 2]).count() == 1
    assert Q.not_empty(df).isEmpty() and Q.not_empty(df.where("false")).count() == 1


def test_multi_state_and_totals(spark):
    rows = [history_row(row=1), history_row(row=2, adr="7"), history_row(key="d:2", row=3)]
    staged = stage(history_frame(spark, rows))
    bad = Q.multi_state_batches(staged).collect()
    assert [(r.booking_key, r.distinct_record_hashes) for r in bad] == [("d:1", 2)]
    current = current_state(dedupe_exact(staged))
    assert Q.current_vs_distinct(staged, current).isEmpty()
    gap = Q.current_vs_distinct(staged, current.where("booking_key = 'd:1'")).first()
    assert (gap.actual_current_rows, gap.expected_distinct_booking_keys) == (1, 2)


def test_expected_current_batch(spark):
    current = spark.createDataFrame([("d:1", "b1")], "booking_key string, current_batch_id string")
    assert Q.expected_current_batch(current, "d:1", "b1").isEmpty()
    assert Q.expected_current_batch(current, "d:1", "b2").first().current_batch_id == "b1"
    assert Q.expected_current_batch(current, "d:2", "b2").first().current_batch_id == "missing_current_row"


def test_warnings(spark):
    rows = [
        history_row(key="ok", adr="500.00"),
        history_row(key="high", adr="500.01"),
        history_row(key="low", adr="-0.01"),
        history_row(key="nights", stays_in_weekend_nights="0", stays_in_week_nights="0"),
        history_row(key="guests", adults="0"),
        history_row(key="dims", market_segment="NULL"),
        history_row(key="day", arrival_date_day_of_month="30", arrival_date_month="February"),
        history_row(key="month", arrival_date_month="x"),
    ]
    current = current_state(dedupe_exact(stage(history_frame(spark, rows))))
    metrics = booking_metrics(current)

    def keys(df):
        return sorted(r.booking_key for r in df.collect())

    assert keys(Q.adr_outliers(metrics)) == ["high", "low"]
    assert keys(Q.zero_nights(metrics)) == ["nights"]
    assert keys(Q.zero_guests(metrics)) == ["guests"]
    assert keys(Q.missing_dimensions(metrics)) == ["dims"]
    assert keys(Q.invalid_arrival_dates(current)) == ["day", "month"]

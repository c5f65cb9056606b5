"""Marts, dimensions, saved aggregates and charts on small facts."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from rows import history_frame, history_row
from stayledger.operators.charts import (
    CHARTS,
    Chart,
    MeanOfMeans,
    Sum,
    apply_filters,
    chart_query,
    stay_length_distribution,
)
from stayledger.operators.marts import DIMENSIONS, MARTS, build_dimension, build_mart
from stayledger.operators.saved import SAVED, reconcile, refresh, save_aggregate
from stayledger.plans.warehouse import metrics_of, plan_warehouse


@pytest.fixture(scope="module")
def metrics(spark):
    rows = [
        history_row(key="d:1", adr="100", is_canceled="0"),
        history_row(key="d:2", adr="50", is_canceled="1", country="GBR"),
        history_row(key="d:3", adr="10", hotel="Resort Hotel", arrival_date_month="Smarch"),
        history_row(key="d:4", adr="20", hotel="NULL", arrival_date_month="April", country=""),
    ]
    return metrics_of(history_frame(spark, rows)).cache()


def test_hotel_mart(metrics):
    rows = {r.hotel: r for r in build_mart(metrics, "mart_hotel_performance").collect()}
    city = rows["City Hotel"]
    assert (city.bookings, city.cancelled_bookings, city.cancellation_rate) == (2, 1, 0.5)
    assert (city.estimated_revenue, city.realized_revenue) == (Decimal("450.00"), Decimal("300.00"))
    assert (city.avg_adr, city.avg_lead_time, city.total_nights) == (75.0, 10.0, 6)
    assert rows[None].bookings == 1


def test_rows_without_date_are_in_no_period(metrics):
    days = {r.arrival_date: r.total_bookings for r in build_mart(metrics, "mart_daily_booking_revenue").collect()}
    assert days == {date(2016, 3, 5): 2, date(2016, 4, 5): 1}
    months = build_mart(metrics, "mart_monthly_booking_revenue").collect()
    assert {r.month_start_date: (r.year_number, r.month_number, r.successful_bookings) for r in months} == {
        date(2016, 3, 1): (2016, 3, 1),
        date(2016, 4, 1): (2016, 4, 1),
    }


def test_simulated_pnl(metrics):
    row = {r.hotel: r for r in build_mart(metrics, "mart_simulated_pnl").collect()}["City Hotel"]
    assert row.simulated_cost == Decimal("6") * 20 + Decimal("300") * Decimal("0.15")
    assert row.simulated_margin == Decimal("300") - row.simulated_cost


def test_dimensions_hold_members_once_and_no_null(metrics):
    assert [r[0] for r in build_dimension(metrics, "dim_hotel").orderBy("hotel").collect()] == [
        "City Hotel",
        "Resort Hotel",
    ]
    assert {r[0] for r in build_dimension(metrics, "dim_country").collect()} == {"PRT", "GBR", "Unknown"}
    assert build_dimension(metrics, "dim_date").count() == 2
    assert build_dimension(metrics, "dim_date").columns[0] == "date_day"


def test_every_relation_is_planned(spark):
    relations = plan_warehouse(history_frame(spark, [history_row()]))
    assert set(MARTS) | set(DIMENSIONS) <= set(relations)
    assert len(MARTS) == 11 and len(DIMENSIONS) == 7


def test_saved_aggregates_are_bucketed_and_replaceable(spark, metrics):
    for name, spec in SAVED.items():
        first = refresh(metrics, name)
        second = refresh(metrics.where("hotel = 'City Hotel'"), name)
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert described["Num Buckets"] == str(spec.buckets)
        assert first.agg({spec.totals[0]: "sum"}).first()[0] > second.agg({spec.totals[0]: "sum"}).first()[0]


def test_saved_aggregate_replaces_a_view_of_that_name(spark, metrics):
    metrics.limit(1).createOrReplaceTempView("taken_name")
    assert save_aggregate(build_mart(metrics, "mart_hotel_performance"), "taken_name", ["hotel"], 2).count() == 3


def test_reconcile(metrics):
    saved = refresh(metrics, "saved_hotel")
    assert reconcile(saved, build_mart(metrics, "mart_hotel_performance"), "saved_hotel").isEmpty()
    other = build_mart(metrics.where("booking_key <> 'd:1'"), "mart_hotel_performance")
    diffs = {r.metric_name: r.diff_value for r in reconcile(saved, other, "saved_hotel").collect()}
    assert diffs == {"bookings": Decimal(1), "realized_revenue": Decimal("300.00")}
    empty = build_mart(metrics.where("false"), "mart_hotel_performance")
    assert reconcile(empty, empty, "saved_hotel").isEmpty()


def test_charts_are_all_there():
    assert len(CHARTS) == 21


def test_top_k_breaks_ties_by_dimension(spark):
    mart = spark.createDataFrame([("b", 1), ("a", 1), ("c", 5), ("d", 0)], "country string, bookings int")
    chart = Chart("x", {"bookings": Sum("bookings")}, ["country"], 3)
    assert [r.country for r in chart_query(mart, chart).collect()] == ["c", "a", "b"]
    assert [r.country for r in chart_query(mart, chart, top=1).collect()] == ["c"]


def test_rates_weigh_groups_and_average_price_does_not(spark):
    mart = spark.createDataFrame(
        [("x", 1, 1, 10.0), ("x", 9, 0, 30.0)], "hotel string, bookings int, cancelled_bookings int, avg_adr double"
    )
    assert chart_query(mart, CHARTS["chart_cancellation_rate"]).first()[0] == pytest.approx(0.1)
    assert chart_query(mart, Chart("x", {"m": MeanOfMeans("avg_adr")})).first()[0] == 20.0


def test_filters_apply_only_where_the_column_exists(spark):
    mart = spark.createDataFrame(
        [("x", date(2016, 1, 1), 1), ("y", date(2016, 2, 1), 2)], "hotel string, month_start_date date, n int"
    )
    chosen = {"hotel": ["y"], "country": ["PRT"]}
    assert [r.n for r in apply_filters(mart, chosen).collect()] == [2]
    bounded = {"month_range": (None, date(2016, 1, 1))}
    assert [r.n for r in apply_filters(mart, bounded).collect()] == [1]
    assert apply_filters(mart, {"hotel": []}).count() == 2


def test_stay_length_distribution(metrics):
    assert [(r[0], r[1]) for r in stay_length_distribution(metrics).collect()] == [("3-5 nights", 4)]

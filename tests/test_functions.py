"""Column expressions on edge values."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rows import history_frame, history_row
from stayledger.functions import buckets, cleaning
from stayledger.functions.measures import safe_ratio
from stayledger.operators.history import clean_and_type, stage
from stayledger.operators.metrics import METRIC_COLUMNS, booking_metrics, fact_bookings
from stayledger.schema import FACT_COLUMNS


def column_of(spark, values, schema, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    return [r[1] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_clean_text(spark):
    values = ["", "  ", "NULL", " NULL ", "null", " a ", None]
    assert column_of(spark, values, "string", cleaning.clean_text) == [None, None, None, None, "null", "a", None]


def test_missing_spellings(spark):
    values = ["", "NULL", " None", "NaN", "na", "N/A\t", None, "0", "nil"]
    assert column_of(spark, values, "string", cleaning.is_missing) == [True] * 7 + [False, False]


def test_month_number(spark):
    values = ["March", "MARCH", "december", "Mär", "", None]
    assert column_of(spark, values, "string", cleaning.month_number) == [3, 3, 12, None, None, None]


def test_effective_time_formats(spark):
    values = ["2026-01-02 03:04:05", "2026-01-02T03:04:05", " 2026-01-02 ", "2026-1-2 3:4:5", "02.01.2026", "T", None]
    first = datetime(2026, 1, 2, 3, 4, 5)
    assert column_of(spark, values, "string", cleaning.parse_effective_at) == [
        first,
        first,
        datetime(2026, 1, 2),
        first,
        None,
        None,
        None,
    ]


@pytest.mark.parametrize(
    ("parts", "wanted"),
    [
        ((2015, 2, 28), date(2015, 2, 28)),
        ((2015, 2, 30), None),
        ((2015, None, 1), None),
        ((2015, 13, 1), None),
        ((2016, 2, 29), date(2016, 2, 29)),
    ],
)
def test_date_from_parts(spark, parts, wanted):
    df = spark.createDataFrame([parts], "y int, m int, d int")
    assert df.select(cleaning.date_from_parts(F.col("y"), F.col("m"), F.col("d"))).first()[0] == wanted


def test_lead_time_edges(spark):
    days = [0, 7, 8, 30, 31, 90, 91, 180, 181, -1]
    labels = ["0-7", "0-7", "8-30", "8-30", "31-90", "31-90", "91-180", "91-180", "180+", "180+"]
    assert column_of(spark, days, "int", buckets.lead_time_bucket) == [f"{x} days" for x in labels]


def test_stay_edges(spark):
    nights = [0, 1, 2, 3, 5, 6, 10, 11]
    labels = ["0", "1-2", "1-2", "3-5", "3-5", "6-10", "6-10", "10+"]
    assert column_of(spark, nights, "int", buckets.stay_length_bucket) == [f"{x} nights" for x in labels]


def test_guest_types(spark):
    guests = [(1, 0, 0), (2, 0, 0), (3, 0, 0), (1, 1, 0), (0, 1, 0), (2, 0, 1), (0, 0, 0)]
    df = spark.createDataFrame([(i, *g) for i, g in enumerate(guests)], "i int, a int, c int, b int")
    kind = buckets.guest_type(F.col("a"), F.col("c"), F.col("b"))
    found = [r[0] for r in df.orderBy("i").select(kind).collect()]
    assert found == ["solo", "couple", "family/group", "family/group", "family/group", "family/group", "unknown"]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None]


def _metrics(spark, **values):
    row = history_row(**values)
    return booking_metrics(clean_and_type(stage(history_frame(spark, [row])))).first()


def test_negative_price_is_floored_and_flagged(spark):
    m = _metrics(spark, adr="-6.38")
    assert (float(m.adr), float(m.source_adr), m.has_negative_adr, float(m.estimated_revenue)) == (0.0, -6.38, 1, 0.0)


def test_missing_price_counts_as_zero(spark):
    m = _metrics(spark, adr="NULL")
    assert (float(m.adr), m.source_adr, m.has_negative_adr) == (0.0, None, 0)


def test_cancelled_booking_has_no_realized_revenue(spark):
    m = _metrics(spark, is_canceled="1", adr="100", stays_in_weekend_nights="0", stays_in_week_nights="2")
    assert (float(m.estimated_revenue), float(m.realized_revenue), m.is_cancelled) == (200.0, 0.0, 1)


def test_bad_values_give_null_not_errors(spark):
    m = _metrics(spark, lead_time="x", adults="-3", children="NA", arrival_date_day_of_month="31", arrival_date_month="June")
    assert (m.lead_time, m.lead_time_bucket, m.adults, m.children, m.arrival_date) == (0, "0-7 days", 0, 0, None)


def test_defaults_and_nulls(spark):
    m = _metrics(spark, country="", customer_type=" NULL ", hotel="NULL", meal="  ")
    assert (m.country, m.customer_type, m.hotel, m.meal, m.company) == ("Unknown", "Unknown", None, None, None)


def test_declared_columns(spark):
    metrics = booking_metrics(clean_and_type(stage(history_frame(spark, [history_row()]))))
    assert metrics.columns == METRIC_COLUMNS and len(METRIC_COLUMNS) == 55
    assert fact_bookings(metrics).columns == FACT_COLUMNS and len(FACT_COLUMNS) == 31

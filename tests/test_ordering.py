"""Numbering, quantiles and the profile against plain Python."""

from __future__ import annotations

import random
import statistics

import pytest

from rows import source_frame
from stayledger.operators.ordering import number_rows, quantiles, value_counts
from stayledger.operators.profile import column_profile, price_spread, revenue_profile


def test_number_rows(spark):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v % 50, v) for v in values], "a int, b int").repartition(7)
    numbered = {(r.a, r.b): r.n for r in number_rows(df, ["a", "b"], "n").collect()}
    assert numbered == {pair: i for i, pair in enumerate(sorted(numbered), 1)}


def _interpolated(values, p):
    ordered = sorted(values)
    place = (len(ordered) - 1) * p
    low = int(place)
    weight = place - low
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] * (1 - weight) + ordered[high] * weight


@pytest.mark.parametrize(
    "values",
    [
        [1, 2, 3, 4],
        [5],
        [1, 1, 1, 1, 1, 1, 9],
        [random.Random(2).randint(0, 300) for _ in range(4001)],
        [7] * 1000 + list(range(2000)),
    ],
)
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v int").repartition(5)
    at = {"q1": 0.25, "median": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}
    row = quantiles(value_counts(df, "v"), "v", at).first().asDict()
    assert row == {name: pytest.approx(_interpolated(values, p)) for name, p in at.items()}


def test_types_and_missing(spark):
    columns = {
        "ints": ["1", " +2", "-3", "1_000", "NA"],
        "decimals": ["1", "2.5", ".5", "1e3", "inf"],
        "dates": ["2015-07-01", "2015-7-2", "null", "", "2016-02-29"],
        "bad_dates": ["2015-07-01", "2015-02-30", "2015-07-02", "2015-07-03", "2015-07-04"],
        "mixed": ["1", "2015-07-01", "3", "4", "5"],
        "texts": ["1-URGENT", "x", "i", "-", "."],
        "empty": ["", None, "N/A", "nan", "none"],
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    found = {r.column_name: (r.row_count, r.missing_count, r.inferred_type) for r in column_profile(df).collect()}
    assert found == {
        "ints": (5, 1, "integer"),
        "decimals": (5, 0, "decimal"),
        "dates": (5, 2, "date"),
        "bad_dates": (5, 0, "string"),
        "mixed": (5, 0, "string"),
        "texts": (5, 0, "string"),
        "empty": (5, 5, "empty"),
    }


def test_price_spread(spark):
    prices = [10.0, 12.5, 11.25, 13.0, 12.0, 500.0, -80.0]
    df = source_frame(spark, [{"adr": str(p)} for p in prices] + [{"adr": "NULL"}, {"adr": "free"}])
    row = price_spread(df).first()
    q1, q3 = _interpolated(prices, 0.25), _interpolated(prices, 0.75)
    assert (row.q1, row.q3) == (pytest.approx(q1), pytest.approx(q3))
    assert (row.min_price, row.max_price, row.outlier_count) == (-80.0, 500.0, 2)
    assert row.mean_price == pytest.approx(statistics.mean(prices))
    assert row.upper_bound == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_revenue_profile(spark):
    df = source_frame(
        spark,
        [
            {"adr": "100", "children": "NA"},
            {"adr": "-10", "is_canceled": "0"},
            {"adr": "50", "is_canceled": "1"},
            {"adr": "x"},
            {"adr": "5", "stays_in_weekend_nights": "0", "stays_in_week_nights": "0", "adults": "0"},
        ],
    )
    row = revenue_profile(df).first()
    assert (row.row_count, row.invalid_rows, row.zero_night_rows, row.zero_guest_rows) == (5, 1, 1, 1)
    assert (float(row.estimated_revenue), float(row.realized_revenue)) == (420.0, 270.0)

"""Derived booking measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.functions import buckets
from stayledger.schema import FACT_COLUMNS, METRIC_COLUMNS

#: Measures whose missing value counts as zero.
ZERO_DEFAULT = [
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "required_car_parking_spaces",
    "total_of_special_requests",
    "lead_time",
]


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def _at_least_zero(name: str):
    return F.greatest(_or_zero(name), F.lit(0))


def booking_metrics(current: DataFrame) -> DataFrame:
    """Nights, guests, floored price, revenue and buckets per current booking."""
    named = current.withColumnsRenamed(
        {"adr": "source_adr", "source_file_name": "source_file", "ingested_at": "loaded_at"}
    )
    counted = named.withColumns(
        {
            "booking_id": F.col("booking_key"),
            **{c: _or_zero(c) for c in ZERO_DEFAULT},
            **{c: _at_least_zero(c) for c in ("adults", "children", "babies")},
            "is_cancelled": _or_zero("is_canceled"),
            "total_nights": _at_least_zero("stays_in_weekend_nights").cast("bigint")
            + _at_least_zero("stays_in_week_nights"),
            "has_negative_adr": F.when(F.col("source_adr") < 0, 1).otherwise(0),
            "adr": _at_least_zero("source_adr").cast("decimal(18,2)"),
        }
    )
    # two INTs of nights have ten digits at most, so the product always fits
    revenue = (F.col("adr") * F.col("total_nights")).cast("decimal(29,2)")
    return counted.withColumns(
        {
            "total_guests": F.col("adults").cast("bigint") + F.col("children") + F.col("babies"),
            "estimated_revenue": revenue,
            "realized_revenue": F.when(F.col("is_cancelled") == 0, revenue).otherwise(0),
            "lead_time_bucket": buckets.lead_time_bucket(F.col("lead_time")),
            "stay_length_bucket": buckets.stay_length_bucket(F.col("total_nights")),
            "guest_type": buckets.guest_type(F.col("adults"), F.col("children"), F.col("babies")),
        }
    ).select(*METRIC_COLUMNS)


def fact_bookings(metrics: DataFrame) -> DataFrame:
    """The columns the marts and dashboards read."""
    return metrics.select(*FACT_COLUMNS)

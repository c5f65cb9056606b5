"""Analysis buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds (both inclusive) and labels of the buckets.
LEAD_TIME_BANDS = [
    (0, 7, "0-7 days"),
    (8, 30, "8-30 days"),
    (31, 90, "31-90 days"),
    (91, 180, "91-180 days"),
]
LEAD_TIME_REST = "180+ days"
STAY_BANDS = [
    (0, 0, "0 nights"),
    (1, 2, "1-2 nights"),
    (3, 5, "3-5 nights"),
    (6, 10, "6-10 nights"),
]
STAY_REST = "10+ nights"
GUEST_SOLO, GUEST_COUPLE, GUEST_GROUP, GUEST_UNKNOWN = "solo", "couple", "family/group", "unknown"


def banded(value: Column, bands: list[tuple[int, int, str]], rest: str) -> Column:
    """Label of the first band that holds the value; ``rest`` for all others."""
    whens = reduce(lambda acc, band: acc.when(value.between(band[0], band[1]), band[2]), bands, F)
    return whens.otherwise(rest)


def lead_time_bucket(days: Column) -> Column:
    return banded(days, LEAD_TIME_BANDS, LEAD_TIME_REST)


def stay_length_bucket(nights: Column) -> Column:
    return banded(nights, STAY_BANDS, STAY_REST)


def guest_type(adults: Column, children: Column, babies: Column) -> Column:
    """Who travels: minors or three adults and more make a group."""
    no_minors = (children == 0) & (babies == 0)
    return (
        F.when(no_minors & (adults == 1), GUEST_SOLO)
        .when(no_minors & (adults == 2), GUEST_COUPLE)
        .when(adults.cast("bigint") + children + babies > 0, GUEST_GROUP)
        .otherwise(GUEST_UNKNOWN)
    )

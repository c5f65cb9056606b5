"""Dashboard queries over the marts, each stated as data and run by one function."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from types import EllipsisType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.measures import ratio_of_sums, total

# The dashboards' row limits of bar charts and tables. Trends have none.
BAR_ROWS, TABLE_ROWS = 10, 50


@dataclass(frozen=True)
class Sum:
    column: str

    def over(self) -> Column:
        return total(self.column)


@dataclass(frozen=True)
class Rate:
    """Ratio of sums, so groups of different size weigh right."""

    part: str
    whole: str

    def over(self) -> Column:
        return ratio_of_sums(self.part, self.whole)


@dataclass(frozen=True)
class MeanOfMeans:
    """Unweighted mean of the groups' means, as the dashboards define average price."""

    column: str

    def over(self) -> Column:
        return F.avg(self.column)


@dataclass(frozen=True)
class Chart:
    """A mart, grouping dimensions, measures (name -> aggregate) and a row limit.

    Rows are ordered by the first measure, highest first, then by dimension;
    a trend is ordered by its dimension.
    """

    mart: str
    measures: dict[str, Sum | Rate | MeanOfMeans]
    dimensions: list[str] = field(default_factory=list)
    limit: int | None = None
    trend: bool = False


HOTEL, DAILY, MONTHLY = "mart_hotel_performance", "mart_daily_booking_revenue", "mart_monthly_booking_revenue"
ROOM, SEGMENT, CHANNEL = "mart_room_performance", "mart_market_segment_performance", "mart_channel_performance"
COUNTRY, LEAD_TIME = "mart_country_performance", "mart_lead_time_analysis"
CUSTOMER, CANCELLATION = "mart_customer_type_performance", "mart_cancellation_analysis"

BOOKINGS = {"bookings": Sum("bookings")}
REALIZED = {"realized_revenue": Sum("realized_revenue")}
ESTIMATED = {"estimated_revenue": Sum("estimated_revenue")}
CANCELLED_SHARE = {"cancellation_rate": Rate("cancelled_bookings", "bookings")}
CANCELLED_SHARE_OF_TOTAL = {"cancellation_rate": Rate("cancelled_bookings", "total_bookings")}

CHARTS: dict[str, Chart] = {
    # single figures
    "chart_total_bookings": Chart(HOTEL, BOOKINGS),
    "chart_cancelled_bookings": Chart(HOTEL, {"cancelled_bookings": Sum("cancelled_bookings")}),
    "chart_cancellation_rate": Chart(HOTEL, CANCELLED_SHARE),
    "chart_estimated_revenue": Chart(HOTEL, ESTIMATED),
    "chart_realized_revenue": Chart(HOTEL, REALIZED),
    "chart_average_adr": Chart(HOTEL, {"average_adr": MeanOfMeans("avg_adr")}),
    # trends
    "chart_daily_bookings": Chart(DAILY, {"bookings": Sum("total_bookings")}, ["arrival_date"], trend=True),
    "chart_monthly_estimated_revenue": Chart(MONTHLY, ESTIMATED, ["month_start_date"], trend=True),
    "chart_monthly_cancellation_rate": Chart(
        MONTHLY, CANCELLED_SHARE_OF_TOTAL, ["month_start_date"], trend=True
    ),
    # bars
    "chart_revenue_by_hotel": Chart(HOTEL, REALIZED, ["hotel"], BAR_ROWS),
    "chart_adr_by_hotel": Chart(HOTEL, {"average_adr": MeanOfMeans("avg_adr")}, ["hotel"], BAR_ROWS),
    "chart_revenue_by_room": Chart(ROOM, REALIZED, ["reserved_room_type"], BAR_ROWS),
    "chart_cancellation_by_room": Chart(ROOM, CANCELLED_SHARE, ["reserved_room_type"], BAR_ROWS),
    "chart_revenue_by_segment": Chart(SEGMENT, REALIZED, ["market_segment"], BAR_ROWS),
    "chart_bookings_by_channel": Chart(CHANNEL, BOOKINGS, ["distribution_channel"], BAR_ROWS),
    "chart_cancellation_by_channel": Chart(CHANNEL, CANCELLED_SHARE, ["distribution_channel"], BAR_ROWS),
    "chart_countries_by_bookings": Chart(COUNTRY, BOOKINGS, ["country"], BAR_ROWS),
    "chart_countries_by_revenue": Chart(COUNTRY, REALIZED, ["country"], BAR_ROWS),
    "chart_cancellation_by_lead_time": Chart(LEAD_TIME, CANCELLED_SHARE, ["lead_time_bucket"], BAR_ROWS),
    # tables
    "chart_customer_types": Chart(
        CUSTOMER, {**BOOKINGS, **REALIZED, **CANCELLED_SHARE}, ["customer_type", "guest_type"], TABLE_ROWS
    ),
    "chart_cancellation_breakdown": Chart(
        CANCELLATION,
        {
            "total_bookings": Sum("total_bookings"),
            "cancelled_bookings": Sum("cancelled_bookings"),
            **CANCELLED_SHARE_OF_TOTAL,
        },
        ["market_segment", "distribution_channel", "deposit_type"],
    ),
}

#: Dashboard filters: name -> column they apply to. Marts without it are left as they are.
FILTERS: dict[str, str] = {
    "date_range": "arrival_date",
    "month_range": "month_start_date",
    "hotel": "hotel",
    "market_segment": "market_segment",
    "distribution_channel": "distribution_channel",
    "country": "country",
    "room_type": "reserved_room_type",
    "customer_type": "customer_type",
}


def apply_filters(mart: DataFrame, chosen: dict[str, list[str] | tuple[date | None, date | None]]) -> DataFrame:
    """Restrict a mart by the chosen filters: value lists, or (from, to) ranges, both inclusive."""
    for name, choice in chosen.items():
        column = FILTERS[name]
        if column not in mart.columns:
            continue
        if name.endswith("_range"):
            low, high = choice
            if low is not None:
                mart = mart.where(F.col(column) >= F.lit(low))
            if high is not None:
                mart = mart.where(F.col(column) <= F.lit(high))
        elif choice:
            mart = mart.where(F.col(column).isin(list(choice)))
    return mart


def chart_query(mart: DataFrame, chart: Chart, top: int | None | EllipsisType = ...) -> DataFrame:
    """Aggregate a mart for a chart. Ordering and limit together run as a top-k.

    ``top`` replaces the chart's own limit; ``None`` gives all rows.
    """
    measures = [measure.over().alias(name) for name, measure in chart.measures.items()]
    if not chart.dimensions:
        return mart.agg(*measures)
    first = next(iter(chart.measures))
    grouped = mart.groupBy(*chart.dimensions).agg(*measures)
    by_measure = [] if chart.trend else [F.desc(first)]
    ordered = grouped.orderBy(*by_measure, *[F.asc(d) for d in chart.dimensions])
    limit = chart.limit if top is ... else top
    return ordered.limit(limit) if limit else ordered


def stay_length_distribution(fact: DataFrame) -> DataFrame:
    """Bookings by stay length, straight from the fact (no mart carries the bucket)."""
    counted = fact.groupBy("stay_length_bucket").agg(F.count(F.lit(1)).alias("bookings"))
    return counted.orderBy(F.desc("bookings"), "stay_length_bucket")

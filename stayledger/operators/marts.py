"""Dimensions and KPI marts, each stated as data and run by one function."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from stayledger.functions.measures import Parts, Rows, mean, safe_ratio

Amounts = type[Rows] | type[Parts]
Measure = Callable[[Amounts], Column]

# Fixed values of the simulated profit and loss: cost per night, share of revenue.
NIGHT_COST = 20
REVENUE_COST_SHARE = "0.15"


def _simulated_cost(of: Amounts) -> Column:
    share = F.lit(REVENUE_COST_SHARE).cast("decimal(2,2)")
    return of.total("total_nights") * NIGHT_COST + of.total("realized_revenue") * share


#: Every measure a mart may publish, from the amounts of a group.
MEASURES: dict[str, Measure] = {
    "bookings": lambda of: of.rows(),
    "total_bookings": lambda of: of.rows(),
    "cancelled_bookings": lambda of: of.total("is_cancelled"),
    "successful_bookings": lambda of: of.rows() - of.total("is_cancelled"),
    "cancellation_rate": lambda of: safe_ratio(of.total("is_cancelled"), of.rows()),
    "total_nights": lambda of: of.total("total_nights"),
    "estimated_revenue": lambda of: of.total("estimated_revenue"),
    "realized_revenue": lambda of: of.total("realized_revenue"),
    "avg_adr": lambda of: mean("adr", of),
    "average_adr": lambda of: mean("adr", of),
    "avg_lead_time": lambda of: mean("lead_time", of),
    "avg_total_guests": lambda of: mean("total_guests", of),
    "simulated_cost": _simulated_cost,
    "simulated_margin": lambda of: of.total("realized_revenue") - _simulated_cost(of),
}

KPIS = ["bookings", "cancelled_bookings", "cancellation_rate", "estimated_revenue", "realized_revenue", "avg_adr"]
PERIOD_KPIS = [
    "total_bookings",
    "cancelled_bookings",
    "successful_bookings",
    "cancellation_rate",
    "total_nights",
    "estimated_revenue",
    "realized_revenue",
    "average_adr",
]


@dataclass(frozen=True)
class Mart:
    """Grouping keys (name -> SQL expression over the fact) and measures."""

    keys: dict[str, str]
    measures: list[str]
    required: list[str] = field(default_factory=list)


def _by(*names: str) -> dict[str, str]:
    return {name: name for name in names}


MARTS: dict[str, Mart] = {
    "mart_daily_booking_revenue": Mart(_by("arrival_date"), PERIOD_KPIS, ["arrival_date"]),
    "mart_monthly_booking_revenue": Mart(
        {
            "year_number": "year(arrival_date)",
            "month_number": "month(arrival_date)",
            "month_start_date": "trunc(arrival_date, 'MM')",
        },
        PERIOD_KPIS,
        ["arrival_date"],
    ),
    "mart_hotel_performance": Mart(_by("hotel"), [*KPIS, "avg_lead_time", "total_nights"]),
    "mart_room_performance": Mart(_by("reserved_room_type", "assigned_room_type"), [*KPIS, "total_nights"]),
    "mart_market_segment_performance": Mart(_by("market_segment"), [*KPIS, "avg_lead_time"]),
    "mart_channel_performance": Mart(_by("distribution_channel"), KPIS),
    "mart_country_performance": Mart(_by("country"), KPIS),
    "mart_cancellation_analysis": Mart(
        _by("hotel", "market_segment", "distribution_channel", "deposit_type", "lead_time_bucket"),
        ["total_bookings", "cancelled_bookings", "cancellation_rate", "avg_lead_time"],
    ),
    "mart_lead_time_analysis": Mart(_by("lead_time_bucket"), KPIS),
    "mart_customer_type_performance": Mart(_by("customer_type", "guest_type"), [*KPIS, "avg_total_guests"]),
    "mart_simulated_pnl": Mart(
        _by("hotel"), ["bookings", "realized_revenue", "simulated_cost", "simulated_margin"]
    ),
}

#: Dimensions: published name -> column of the metrics relation, and columns that must be present.
DIMENSIONS: dict[str, tuple[dict[str, str], list[str]]] = {
    "dim_date": (
        {
            "date_day": "arrival_date",
            "year_number": "arrival_date_year",
            "month_number": "arrival_month_number",
            "month_name": "arrival_date_month",
            "week_number": "arrival_date_week_number",
            "day_of_month": "arrival_date_day_of_month",
        },
        ["date_day"],
    ),
    "dim_hotel": (_by("hotel"), ["hotel"]),
    "dim_room": (
        _by("reserved_room_type", "assigned_room_type"),
        ["reserved_room_type", "assigned_room_type"],
    ),
    "dim_market_segment": (_by("market_segment"), ["market_segment"]),
    "dim_channel": (_by("distribution_channel"), ["distribution_channel"]),
    "dim_country": (_by("country"), ["country"]),
    "dim_customer_type": (_by("customer_type", "is_repeated_guest"), ["customer_type"]),
}


#: Dimensions whose members are the keys of a mart.
OF_MART = {
    "dim_hotel": "mart_hotel_performance",
    "dim_room": "mart_room_performance",
    "dim_market_segment": "mart_market_segment_performance",
    "dim_channel": "mart_channel_performance",
    "dim_country": "mart_country_performance",
}


def of_mart(marts: dict[str, DataFrame], name: str) -> DataFrame:
    """The same members as ``build_dimension`` gives, from a mart's rows."""
    columns, required = DIMENSIONS[name]
    return _require(marts[OF_MART[name]].select(*columns), required)


def _require(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns) if columns else df


def grouped_fact(fact: DataFrame, mart: Mart) -> GroupedData:
    """The fact's rows by the mart's keys."""
    keys = [F.expr(expression).alias(name) for name, expression in mart.keys.items()]
    return _require(fact, mart.required).groupBy(*keys)


def kpi_mart(fact: DataFrame, mart: Mart) -> DataFrame:
    """Group the fact by the mart's keys. One shuffle of partial aggregates."""
    return grouped_fact(fact, mart).agg(*[MEASURES[name](Rows).alias(name) for name in mart.measures])


def summed_columns(name: str) -> list[str]:
    """The fact's columns that a mart's measures add up."""
    found: list[str] = []

    class Noted(Rows):
        @staticmethod
        def total(column: str) -> Column:
            found.append(column)
            return Rows.total(column)

    for measure in MARTS[name].measures:
        MEASURES[measure](Noted)
    return list(dict.fromkeys(found))


def build_mart(fact: DataFrame, name: str) -> DataFrame:
    return kpi_mart(fact, MARTS[name])


def build_dimension(metrics: DataFrame, name: str) -> DataFrame:
    """Distinct members of a dimension; rows without the key are left out."""
    columns, required = DIMENSIONS[name]
    members = metrics.select(*[F.col(c).alias(alias) for alias, c in columns.items()])
    return _require(members, required).distinct()

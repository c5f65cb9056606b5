"""Data-quality checks. A check passes when it has no failures.

Row-level checks of a relation are counted together in one pass over it; the
suite is one DataFrame with a line per check.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.operators.saved import SAVED, reconcile
from stayledger.schema import UNKNOWN

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Checks:
    """Declared checks of one relation."""

    not_empty: bool = False
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    non_negative: list[str] = field(default_factory=list)
    accepted: dict[str, list[int]] = field(default_factory=dict)


AMOUNTS = ["total_nights", "adr", "estimated_revenue", "realized_revenue"]

# Which columns of which relation are checked for what.
DECLARED: dict[str, Checks] = {
    "staged_history": Checks(
        not_null=[
            "booking_key",
            "batch_id",
            "batch_sequence",
            "batch_effective_at",
            "etl_year",
            "etl_month",
            "etl_day",
            "etl_date",
            "raw_batch_sequence",
            "record_hash",
        ]
    ),
    "deduped_history": Checks(not_null=["booking_key", "batch_id", "record_hash"]),
    "current_bookings": Checks(not_null=["booking_key", "hotel", "arrival_date"], unique=["booking_key"]),
    "booking_metrics": Checks(
        not_null=["booking_key", "booking_id"], unique=["booking_key"], non_negative=AMOUNTS
    ),
    "fact_bookings": Checks(
        not_empty=True,
        not_null=["booking_key", "booking_id", "arrival_date", "hotel", "is_cancelled"],
        unique=["booking_key"],
        non_negative=AMOUNTS,
        accepted={"is_cancelled": [0, 1]},
    ),
    "dim_date": Checks(not_empty=True, not_null=["date_day"]),
    "dim_hotel": Checks(not_empty=True, not_null=["hotel"]),
    "dim_room": Checks(not_empty=True, not_null=["reserved_room_type", "assigned_room_type"]),
    "dim_market_segment": Checks(not_empty=True, not_null=["market_segment"]),
    "dim_channel": Checks(not_empty=True, not_null=["distribution_channel"]),
    "dim_country": Checks(not_empty=True, not_null=["country"]),
    "dim_customer_type": Checks(not_empty=True, not_null=["customer_type"]),
    "mart_daily_booking_revenue": Checks(not_empty=True, not_null=["arrival_date"]),
    "mart_monthly_booking_revenue": Checks(not_empty=True, not_null=["month_start_date"]),
    "mart_hotel_performance": Checks(not_empty=True, not_null=["hotel"]),
    "mart_room_performance": Checks(not_empty=True, not_null=["reserved_room_type", "assigned_room_type"]),
    "mart_market_segment_performance": Checks(not_empty=True, not_null=["market_segment"]),
    "mart_channel_performance": Checks(not_empty=True, not_null=["distribution_channel"]),
    "mart_country_performance": Checks(not_empty=True, not_null=["country"]),
    "mart_cancellation_analysis": Checks(not_empty=True, not_null=["hotel", "lead_time_bucket"]),
    "mart_lead_time_analysis": Checks(not_empty=True, not_null=["lead_time_bucket"]),
    "mart_customer_type_performance": Checks(not_empty=True, not_null=["customer_type", "guest_type"]),
    "mart_simulated_pnl": Checks(not_empty=True, not_null=["hotel"]),
    "saved_daily": Checks(not_empty=True, not_null=["arrival_date"]),
    "saved_monthly": Checks(not_empty=True, not_null=["month_start_date"]),
    "saved_hotel": Checks(not_empty=True, not_null=["hotel"]),
}

#: Price range outside which a booking is reported.
PRICE_WARN_RANGE = (0, 500)

#: Dimensions a complete booking has.
CORE_DIMENSIONS = [
    "country",
    "market_segment",
    "distribution_channel",
    "reserved_room_type",
    "assigned_room_type",
    "customer_type",
]


# --- failing rows, one function per check kind ------------------------------


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where(F.col("occurrences") > 1)


def accepted_values(df: DataFrame, column: str, values: list[int]) -> DataFrame:
    return df.where(~F.col(column).isin(values))


def not_empty(df: DataFrame) -> DataFrame:
    """One row if ``df`` has none. Reads no more than one row of it per task."""
    found = df.limit(1).agg(F.count(F.lit(1)).alias("found"))
    return found.where(F.col("found") == 0).select(F.lit(1).alias("failure"))


# --- invariants --------------------------------------------------------------


def multi_state_batches(staged: DataFrame) -> DataFrame:
    """Bookings with more than one business state within a batch."""
    states = staged.groupBy("booking_key", "batch_id").agg(
        F.count_distinct("record_hash").alias("distinct_record_hashes")
    )
    return states.where(F.col("distinct_record_hashes") > 1)


def row_totals(staged: DataFrame, current: DataFrame) -> DataFrame:
    """Current rows next to distinct keys of the history, one row."""
    keys = staged.select("booking_key").distinct()
    sides = {
        "actual_current_rows": current.select("booking_key"),
        "expected_distinct_booking_keys": keys.where(F.col("booking_key").isNotNull()),
    }
    counted = [
        df.agg(*[F.count(F.lit(1) if side == name else F.lit(None)).alias(name) for name in sides])
        for side, df in sides.items()
    ]
    both = _union_all(counted)
    return both.agg(*[F.sum(name).alias(name) for name in sides])


def current_vs_distinct(staged: DataFrame, current: DataFrame) -> DataFrame:
    """The two totals, if they differ."""
    totals = row_totals(staged, current)
    return totals.where(F.col("actual_current_rows") != F.col("expected_distinct_booking_keys"))


def expected_current_batch(current: DataFrame, booking_key: str, batch_id: str) -> DataFrame:
    """A booking that is current in another batch than expected, or not at all."""
    found = current.where(F.col("booking_key") == booking_key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.when(F.col("current_batch_id") != batch_id, F.col("current_batch_id"))).alias("other_batch"),
    )
    batch = F.when(F.col("rows") == 0, "missing_current_row").otherwise(F.col("other_batch"))
    failing = found.select(F.lit(booking_key).alias("booking_key"), batch.alias("current_batch_id"))
    return failing.where(F.col("current_batch_id").isNotNull())


# --- warnings ----------------------------------------------------------------


def price_out_of_range() -> Column:
    low, high = PRICE_WARN_RANGE
    return (F.col("source_adr") < low) | (F.col("source_adr") > high)


def arrival_date_is_invalid() -> Column:
    """No date, no year, or a month or day out of range. NULL parts are caught by the date."""
    return (
        F.col("arrival_date").isNull()
        | F.col("arrival_date_year").isNull()
        | ~F.col("arrival_month_number").between(1, 12)
        | ~F.col("arrival_date_day_of_month").between(1, 31)
    )


def core_dimension_is_missing() -> Column:
    bad = F.col("hotel").isNull()
    for c in CORE_DIMENSIONS:
        bad = bad | F.col(c).isNull() | (F.col(c) == UNKNOWN)
    return bad


#: Warning -> relation it belongs to and condition, all over columns of the metrics relation.
WARNINGS = {
    "adr_outliers": ("booking_metrics", price_out_of_range),
    "invalid_arrival_dates": ("current_bookings", arrival_date_is_invalid),
    "missing_dimensions": ("booking_metrics", core_dimension_is_missing),
    "zero_guests": ("booking_metrics", lambda: F.col("total_guests") == 0),
    "zero_nights": ("booking_metrics", lambda: F.col("total_nights") == 0),
}


def _warned(df: DataFrame, warning: str, columns: list[str]) -> DataFrame:
    return df.where(WARNINGS[warning][1]()).select("booking_key", "current_batch_id", *columns)


def adr_outliers(metrics: DataFrame) -> DataFrame:
    return _warned(metrics, "adr_outliers", ["source_adr"])


def invalid_arrival_dates(current: DataFrame) -> DataFrame:
    parts = ["arrival_date_year", "arrival_month_number", "arrival_date_day_of_month", "arrival_date"]
    return _warned(current, "invalid_arrival_dates", parts)


def missing_dimensions(metrics: DataFrame) -> DataFrame:
    return _warned(metrics, "missing_dimensions", ["hotel", *CORE_DIMENSIONS])


def zero_guests(metrics: DataFrame) -> DataFrame:
    return _warned(metrics, "zero_guests", ["total_guests"])


def zero_nights(metrics: DataFrame) -> DataFrame:
    return _warned(metrics, "zero_nights", ["total_nights"])


# --- the suite ---------------------------------------------------------------


def _line(check: str, relation: str, column: str, severity: str, failures: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(relation).alias("relation"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Union as a balanced tree, which keeps the plan shallow and quick to analyse."""
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]


def _counted(df: DataFrame, lines: list[tuple[str, str, str, str, Column]]) -> DataFrame:
    """Failure counts of several checks in one aggregate, as one line per check.

    A line is ``(check, relation, column, severity, aggregate)``.
    """
    counts = df.agg(*[line[4].alias(f"f{i}") for i, line in enumerate(lines)])
    structs = [_line(*line[:4], F.col(f"f{i}")) for i, line in enumerate(lines)]
    return counts.select(F.inline(F.array(*structs)))


def _row_count() -> Column:
    return F.count(F.lit(1))


def check_relation(df: DataFrame, relation: str, checks: Checks, severity: str = ERROR) -> DataFrame:
    """All declared checks of a relation, those on rows in one pass."""
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in checks.not_null}
    counts |= {("non_negative", c): F.count_if(F.col(c) < 0) for c in checks.non_negative}
    counts |= {
        ("accepted_values", c): F.count_if(~F.col(c).isin(values)) for c, values in checks.accepted.items()
    }
    if checks.not_empty:
        counts["not_empty", ""] = F.when(_row_count() == 0, 1).otherwise(0)
    lines = [(check, relation, column, severity, count) for (check, column), count in counts.items()]
    parts = [_counted(df, lines)] if lines else []
    for c in checks.unique:
        parts.append(_counted(unique(df, c), [("unique", relation, c, severity, _row_count())]))
    return _union_all(parts)


def sql_checks(relations: dict[str, DataFrame], expected_current: dict[str, str]) -> DataFrame:
    """Invariants, reconciliations, expected current batches and warnings."""
    staged, current = relations["staged_history"], relations["current_bookings"]
    failing = {
        ("current_vs_distinct", "current_bookings", ""): current_vs_distinct(staged, current),
        ("multi_state_batches", "staged_history", ""): multi_state_batches(staged),
    }
    for key, batch in expected_current.items():
        failing["current_batch", "current_bookings", key] = expected_current_batch(current, key, batch)
    for name, spec in SAVED.items():
        failing["reconcile", name, ""] = reconcile(relations[name], relations[spec.mart], name)
    parts = [_counted(df, [(*line, ERROR, _row_count())]) for line, df in failing.items()]
    warnings = [
        (check, relation, "", WARN, F.count_if(condition()))
        for check, (relation, condition) in WARNINGS.items()
    ]
    return _union_all([*parts, _counted(relations["booking_metrics"], warnings)])


def declared_checks(relations: dict[str, DataFrame]) -> DataFrame:
    return _union_all([check_relation(relations[name], name, checks) for name, checks in DECLARED.items()])


def check_suite(relations: dict[str, DataFrame], expected_current: dict[str, str] | None = None) -> DataFrame:
    """Every check with its severity and failure count."""
    return declared_checks(relations).unionByName(sql_checks(relations, expected_current or {}))


def object_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """Rows per relation, counted in one job."""
    parts = [
        df.agg(F.lit(name).alias("object_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in relations.items()
    ]
    return _union_all(parts)


def run_validation(relations: dict[str, DataFrame], expected_current: dict[str, str] | None = None) -> DataFrame:
    """Post-run validation: ``(check_name, subject, value, passed)``.

    Objects hold rows, no batch holds several states of a booking, current rows
    equal distinct keys, and the given bookings are current in the given batch.
    """
    staged, current = relations["staged_history"], relations["current_bookings"]

    def lines(df: DataFrame, check: str, subject: Column, value: Column, passed: Column) -> DataFrame:
        return df.select(
            F.lit(check).alias("check_name"),
            subject.alias("subject"),
            value.cast("bigint").alias("value"),
            passed.cast("int").alias("passed"),
        )

    states = multi_state_batches(staged).agg(F.count(F.lit(1)).alias("n"))
    totals = row_totals(staged, current)
    gap = F.abs(F.col("actual_current_rows") - F.col("expected_distinct_booking_keys"))
    parts = [
        lines(
            object_counts(relations),
            "has_rows",
            F.col("object_name"),
            F.col("row_count"),
            F.col("row_count") > 0,
        ),
        lines(states, "multi_state_batches", F.lit("staged_history"), F.col("n"), F.col("n") == 0),
        lines(totals, "current_vs_distinct", F.lit("current_bookings"), gap, gap == 0),
    ]
    for key, batch in (expected_current or {}).items():
        failing = expected_current_batch(current, key, batch).agg(F.count(F.lit(1)).alias("n"))
        parts.append(lines(failing, "current_batch", F.lit(key), F.col("n"), F.col("n") == 0))
    return _union_all(parts)

"""Column lists and table schemas of the booking data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names and order of the columns of the public booking data set,
# the metrics relation, the fact, the batch files and the history table. They
# must match the files and the published tables.
# ---------------------------------------------------------------------------
SOURCE_COLUMNS = [
    "hotel",
    "is_canceled",
    "lead_time",
    "arrival_date_year",
    "arrival_date_month",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "meal",
    "country",
    "market_segment",
    "distribution_channel",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "reserved_room_type",
    "assigned_room_type",
    "booking_changes",
    "deposit_type",
    "agent",
    "company",
    "days_in_waiting_list",
    "customer_type",
    "adr",
    "required_car_parking_spaces",
    "total_of_special_requests",
    "reservation_status",
    "reservation_status_date",
]

# Columns of the metrics relation, in order.
METRIC_COLUMNS = [
    "booking_key",
    "booking_id",
    "source_dataset",
    "original_source_row_number",
    "current_batch_id",
    "current_batch_sequence",
    "etl_year",
    "etl_month",
    "etl_day",
    "etl_date",
    "raw_batch_sequence",
    "record_hash",
    "hotel",
    "arrival_date",
    "arrival_date_year",
    "arrival_month_number",
    "arrival_date_month",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "country",
    "market_segment",
    "distribution_channel",
    "reserved_room_type",
    "assigned_room_type",
    "customer_type",
    "deposit_type",
    "reservation_status",
    "reservation_status_date",
    "meal",
    "agent",
    "company",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "required_car_parking_spaces",
    "total_of_special_requests",
    "is_cancelled",
    "lead_time",
    "total_nights",
    "adults",
    "children",
    "babies",
    "total_guests",
    "source_adr",
    "has_negative_adr",
    "adr",
    "estimated_revenue",
    "realized_revenue",
    "lead_time_bucket",
    "stay_length_bucket",
    "guest_type",
    "source_file",
    "loaded_at",
]

# Columns the booking fact publishes, in order.
FACT_COLUMNS = [
    "booking_key",
    "booking_id",
    "source_dataset",
    "original_source_row_number",
    "current_batch_id",
    "current_batch_sequence",
    "record_hash",
    "arrival_date",
    "hotel",
    "country",
    "market_segment",
    "distribution_channel",
    "reserved_room_type",
    "assigned_room_type",
    "customer_type",
    "deposit_type",
    "total_nights",
    "total_guests",
    "adr",
    "estimated_revenue",
    "realized_revenue",
    "is_cancelled",
    "lead_time",
    "lead_time_bucket",
    "stay_length_bucket",
    "guest_type",
    "reservation_status",
    "reservation_status_date",
    "has_negative_adr",
    "source_file",
    "loaded_at",
]

BATCH_COLUMNS = [
    "source_dataset",
    "original_source_row_number",
    "booking_key",
    "batch_id",
    "batch_sequence",
    "batch_effective_at",
    "batch_row_number",
    "synthetic_operation",
]

#: Technical columns of the history table, name -> type, in table order.
HISTORY_TECHNICAL = {
    "source_dataset": T.StringType(),
    "original_source_row_number": T.LongType(),
    "booking_key": T.StringType(),
    "batch_id": T.StringType(),
    "batch_sequence": T.IntegerType(),
    "batch_effective_at": T.TimestampType(),
    "batch_row_number": T.LongType(),
    "etl_year": T.IntegerType(),
    "etl_month": T.IntegerType(),
    "etl_day": T.IntegerType(),
    "etl_date": T.StringType(),
    "raw_batch_sequence": T.StringType(),
    "source_file_name": T.StringType(),
    "source_object_path": T.StringType(),
    "file_hash": T.StringType(),
    "ingested_at": T.TimestampType(),
    "row_ingestion_id": T.StringType(),
    "synthetic_operation": T.StringType(),
}

#: Source columns typed as INT once cleaned.
INT_COLUMNS = [
    "is_canceled",
    "lead_time",
    "arrival_date_year",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "required_car_parking_spaces",
    "total_of_special_requests",
]

#: Dimensions whose missing values become the label UNKNOWN.
DEFAULTED_DIMENSIONS = [
    "country",
    "market_segment",
    "distribution_channel",
    "reserved_room_type",
    "assigned_room_type",
    "deposit_type",
    "customer_type",
    "reservation_status",
]

UNKNOWN = "Unknown"
PRICE_TYPE = "decimal(18,2)"

#: Partition column of the history table.
HISTORY_PARTITION = "etl_date"
# ---------------------------------------------------------------------------

HISTORY_COLUMNS = [*HISTORY_TECHNICAL, *SOURCE_COLUMNS]


def all_strings(columns: list[str]) -> T.StructType:
    """A schema that reads every column as text."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


BATCH_FILE_SCHEMA = all_strings([*BATCH_COLUMNS, *SOURCE_COLUMNS])


HISTORY_SCHEMA = T.StructType(
    [T.StructField(name, kind, True) for name, kind in HISTORY_TECHNICAL.items()]
    + all_strings(SOURCE_COLUMNS).fields
)

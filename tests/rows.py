"""Small literal frames."""

from __future__ import annotations

from datetime import datetime

from stayledger.schema import HISTORY_SCHEMA, SOURCE_COLUMNS, all_strings

DEFAULTS = {
    "hotel": "City Hotel",
    "is_canceled": "0",
    "lead_time": "10",
    "arrival_date_year": "2016",
    "arrival_date_month": "March",
    "arrival_date_week_number": "10",
    "arrival_date_day_of_month": "5",
    "stays_in_weekend_nights": "1",
    "stays_in_week_nights": "2",
    "adults": "2",
    "children": "0",
    "babies": "0",
    "meal": "BB",
    "country": "PRT",
    "market_segment": "Direct",
    "distribution_channel": "Direct",
    "is_repeated_guest": "0",
    "previous_cancellations": "0",
    "previous_bookings_not_canceled": "0",
    "reserved_room_type": "A",
    "assigned_room_type": "A",
    "booking_changes": "0",
    "deposit_type": "No Deposit",
    "agent": "9",
    "company": "NULL",
    "days_in_waiting_list": "0",
    "customer_type": "Transient",
    "adr": "100.00",
    "required_car_parking_spaces": "0",
    "total_of_special_requests": "0",
    "reservation_status": "Check-Out",
    "reservation_status_date": "2016-03-08",
}


def source_row(**values) -> dict:
    return {**DEFAULTS, **values}


def source_frame(spark, rows: list[dict]):
    return spark.createDataFrame(
        [tuple(source_row(**r)[c] for c in SOURCE_COLUMNS) for r in rows], all_strings(SOURCE_COLUMNS)
    )


def history_row(key="d:1", batch="b1", sequence=1, row=1, rid=None, **values) -> dict:
    technical = {
        "source_dataset": "d",
        "original_source_row_number": row,
        "booking_key": key,
        "batch_id": batch,
        "batch_sequence": sequence,
        "batch_effective_at": datetime(2026, 1, sequence),
        "batch_row_number": row,
        "ingested_at": datetime(2026, 2, 1),
        "row_ingestion_id": rid or f"{batch}-{row:05d}",
        "source_file_name": f"{batch}.csv",
    }
    known = {f.name for f in HISTORY_SCHEMA}
    return {**technical, **source_row(), **{k: v for k, v in values.items() if k in known}}


def history_frame(spark, rows: list[dict]):
    return spark.createDataFrame(
        [tuple(r.get(f.name) for f in HISTORY_SCHEMA) for r in rows], HISTORY_SCHEMA
    )

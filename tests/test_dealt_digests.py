"""Digests travel as bytes, and results that use few columns move few."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from rows import history_frame, history_row
from stayledger.operators.history import DIGESTS, dealt_by_booking, dedupe_exact, dedupe_grouped, stage
from stayledger.plans.warehouse import current_bookings, dealt_current, rows_by_booking
from stayledger.sources import history as H


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _same(ours, theirs) -> None:
    assert ours.schema == theirs.schema
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def _odd_history(spark):
    """Copies, versions, rows without key or batch, and ids that are digests, nearly digests or none."""
    rows = []
    for k in range(24):
        ids = [_digest(str(k // 2)), f"b-{k // 2:03d}", _digest(str(k)).upper(), _digest(str(k)) + "\n", None]
        row = history_row(key=None if k % 7 == 0 else f"d:{k % 5}", row=k // 2, sequence=1 + k % 2, adr=f"{k % 3}.00")
        row |= {"batch_id": None if k % 11 == 0 else f"b{1 + k % 2}", "row_ingestion_id": ids[k % 5]}
        row |= {"file_hash": ids[(k + 1) % 5], "ingested_at": datetime(2026, 2, 1 + k % 3), "source_file_name": f"f{k}"}
        rows.append(row)
    return history_frame(spark, rows)


def test_digests_travel_as_bytes_and_arrive_as_they_were(spark):
    rows = stage(_odd_history(spark))
    dealt = dealt_by_booking(rows, 3)
    _same(dealt, rows)
    text = _plan(dealt.select("booking_key", *DIGESTS))
    assert text.count("Exchange") == 1 and all(f"AS _{c}#" in text[text.index("Exchange") :] for c in DIGESTS)


def test_dealt_current_bookings_are_the_current_ones(spark):
    rows = _odd_history(spark)
    _same(dealt_current(rows), current_bookings(rows))
    assert _plan(dealt_current(rows)).count("Exchange") == 1
    stored, wanted = rows_by_booking(rows, 4), stage(rows)
    assert stored.exceptAll(wanted).isEmpty() and wanted.exceptAll(stored).isEmpty()


def test_grouped_dedup_keeps_the_same_rows_and_moves_what_is_used(spark):
    rows = stage(_odd_history(spark))
    rows = rows.unionByName(rows.withColumn("record_hash", F.lit("short"))).unionByName(rows.withColumn("record_hash", F.lit(None)))
    _same(dedupe_grouped(rows), dedupe_exact(rows))
    counted = _plan(H.batch_counts(dedupe_grouped(stage(_odd_history(spark)))))
    assert "row_ingestion_id" not in counted[: counted.index("Scan")] and "unhex" in counted

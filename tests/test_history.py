"""Staging, exact dedup and current state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rows import history_frame, history_row
from stayledger.operators.history import current_state, dedupe_exact, latest_per_key, stage
from stayledger.sources.history import align_history


def _hash(spark, **values):
    return stage(history_frame(spark, [history_row(**values)])).first().record_hash


def test_hash_ignores_case_and_outer_spaces(spark):
    assert _hash(spark, hotel=" City Hotel") == _hash(spark, hotel="city hotel ")


def test_hash_is_over_raw_text(spark):
    assert _hash(spark, agent=None) == _hash(spark, agent="")
    assert _hash(spark, agent="") != _hash(spark, agent="NULL")
    assert _hash(spark, adr="75") != _hash(spark, adr="75.00")


def test_hash_keeps_columns_apart(spark):
    assert _hash(spark, agent="1", company="") != _hash(spark, agent="", company="1")


def test_load_date_fallback(spark):
    row = stage(history_frame(spark, [history_row(sequence=7)])).first()
    assert (row.etl_year, row.etl_month, row.etl_day, row.etl_date, row.raw_batch_sequence) == (
        2026,
        1,
        7,
        "20260107",
        "007",
    )
    given = {**history_row(), "etl_date": "20200101", "raw_batch_sequence": "042"}
    row = stage(history_frame(spark, [given])).first()
    assert (row.etl_date, row.raw_batch_sequence) == ("20200101", "042")


def test_exact_duplicates_go_and_replays_stay(spark):
    rows = [
        history_row(row=1, rid="b"),
        history_row(row=2, rid="a"),
        history_row(row=3, adr="1"),
        history_row(batch="b2", sequence=2, row=1, rid="c"),
    ]
    kept = dedupe_exact(stage(history_frame(spark, rows))).collect()
    assert sorted(r.row_ingestion_id for r in kept) == ["a", "b1-00003", "c"]


def test_forced_reload_keeps_the_earlier_load(spark):
    early = history_row(rid="x")
    late = {**history_row(rid="x"), "ingested_at": datetime(2026, 3, 1)}
    kept = dedupe_exact(stage(history_frame(spark, [late, early]))).collect()
    assert [r.ingested_at for r in kept] == [datetime(2026, 2, 1)]


def test_latest_record_wins(spark):
    rows = [
        history_row(batch="b1", sequence=1, row=9, adr="1"),
        history_row(batch="b2", sequence=2, row=1, adr="2"),
        history_row(batch="b2", sequence=2, row=2, adr="3"),
    ]
    current = current_state(dedupe_exact(stage(history_frame(spark, rows)))).collect()
    assert [(r.current_batch_id, float(r.adr)) for r in current] == [("b2", 3.0)]


def test_same_order_is_decided_the_same_way_every_time(spark):
    rows = [history_row(rid="same", adr=str(i)) for i in range(20)]
    winners = set()
    for order in (rows, rows[::-1]):
        staged = stage(history_frame(spark, order).repartition(5))
        winners.add(latest_per_key(dedupe_exact(staged)).first().record_hash)
    assert len(winners) == 1


def test_a_key_with_a_third_of_all_rows(spark):
    """The hot key and the hot group of copies give one row each, whole and right."""
    base = history_frame(spark, [history_row()])
    hot = (
        spark.range(20_000)
        .crossJoin(base.drop("batch_row_number", "row_ingestion_id", "booking_key", "adr"))
        .withColumns(
            {
                "booking_key": F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))),
                "batch_row_number": F.col("id"),
                "row_ingestion_id": F.lpad(F.col("id").cast("string"), 8, "0"),
                "adr": F.when(F.col("id") % 2 == 0, "5").otherwise(F.col("id").cast("string")),
            }
        )
        .select(base.columns)
    )
    staged = stage(hot.repartition(8))
    deduped = dedupe_exact(staged)
    brute = {}
    for key, i, adr in [(r[0], r[1], r[2]) for r in hot.select("booking_key", "batch_row_number", "adr").collect()]:
        group = brute.setdefault(key, {})
        group[adr] = min(group.get(adr, i), i)
    assert deduped.count() == sum(len(group) for group in brute.values())
    current = {r.booking_key: r.batch_row_number for r in latest_per_key(deduped).collect()}
    assert current == {key: max(group.values()) for key, group in brute.items()}


def test_align_adds_missing_and_drops_legacy_columns(spark):
    old = history_frame(spark, [history_row()]).drop("etl_date", "etl_year", "file_hash")
    aligned = align_history(old.withColumn("record_hash", F.lit("x")).withColumn("watermark_date", F.lit("y")))
    assert aligned.columns == history_frame(spark, []).columns
    row = aligned.first()
    assert (row.etl_date, row.etl_year, row.booking_key) == (None, None, "d:1")

"""Merging deliveries equals rebuilding, whatever order and cut they come in."""

from __future__ import annotations

import csv
import random
from datetime import datetime

import pytest

from rows import history_frame, history_row, source_row
from stayledger.operators import incremental as I
from stayledger.operators.history import current_state, dedupe_exact, stage
from stayledger.operators.marts import MARTS, build_mart, summed_columns
from stayledger.plans.refresh import STATE, merge_rows, open_refreshed, refresh_warehouse, rows_of_files
from stayledger.plans.warehouse import fact_of
from stayledger.schema import BATCH_COLUMNS, SOURCE_COLUMNS
from stayledger.session import new_path
from stayledger.sources.history import ingest, read_history, read_manifest
from stayledger.sources.versions import Versions


def drawn(seed, n=260):
    """Bookings over few batches with ties, replays, repeated rows and null keys."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        sequence = rng.randrange(1, 5)
        row = history_row(
            key=rng.choice([f"d:{rng.randrange(40)}"] * 9 + [None]), batch=f"b{sequence}", sequence=sequence,
            row=rng.randrange(1, 5), rid=f"r{rng.randrange(60):03d}", adr=rng.choice(["10", "20", "-1", "NULL"]),
            hotel=rng.choice(["City Hotel", "Resort Hotel", "NULL"]), is_canceled=rng.choice(["0", "1"]),
            arrival_date_month=rng.choice(["March", "April", "x"]), lead_time=rng.choice(["1", "40", ""]),
            country=rng.choice(["PRT", "GBR", "FRA"]), customer_type=rng.choice(["a", "b"]),
        )
        rows.append(row | {"ingested_at": datetime(2026, 2, rng.randrange(1, 4))})
    return rows


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_state_after_deliveries_is_the_state_of_all(spark, seed):
    rows = drawn(seed)
    rng = random.Random(seed)
    cuts = [rng.randrange(4) for _ in rows]
    deliveries = [history_frame(spark, [r for r, c in zip(rows, cuts) if c == k]) for k in range(4)]
    state = I.state_of(deliveries[0])
    for delivery in deliveries[1:]:
        state = I.merge_state(state, delivery)
    wanted = current_state(dedupe_exact(stage(history_frame(spark, rows))))
    assert ordered(current_state(state)) == ordered(wanted)
    assert ordered(state) == ordered(I.state_of(history_frame(spark, rows)))


def test_state_keeps_only_the_latest_batch(spark):
    rows = [history_row(sequence=k, batch=f"b{k}", adr=str(a), row=a) for k in (1, 2) for a in (1, 2)]
    assert {r.batch_id for r in I.state_of(history_frame(spark, rows)).collect()} == {"b2"}
    assert I.state_of(history_frame(spark, rows)).count() == 2


@pytest.fixture(scope="module")
def merged(spark):
    """A warehouse after two deliveries, and the facts of both states."""
    rows = drawn(7)
    store = Versions(spark, new_path(spark, "refreshed"))
    deliveries = [history_frame(spark, rows[:180]), history_frame(spark, rows[180:])]
    for delivery in deliveries:
        version, tables = store.current()
        store.commit(merge_rows(store, tables, delivery, buckets=4), on=version)
    return store, rows


@pytest.mark.parametrize("name", MARTS)
def test_merged_marts_equal_rebuilt_ones(spark, merged, name):
    store, rows = merged
    found = open_refreshed(spark, store.root)[name]
    wanted = build_mart(fact_of(history_frame(spark, rows)), name)
    assert found.schema.simpleString() == wanted.schema.simpleString()
    assert ordered(found) == ordered(wanted)


def test_an_older_version_stays_readable(spark, merged):
    store, rows = merged
    older = open_refreshed(spark, store.root, version=1)["mart_hotel_performance"]
    assert ordered(older) == ordered(build_mart(fact_of(history_frame(spark, rows[:180])), "mart_hotel_performance"))


def test_only_touched_groups_get_parts(spark):
    first = fact_of(history_frame(spark, [history_row(key="d:1"), history_row(key="d:2", hotel="Resort Hotel")]))
    second = fact_of(history_frame(spark, [history_row(key="d:1", sequence=2, batch="b2", is_canceled="1")]))
    before = first.where("booking_key = 'd:1'")
    parts = I.changed_parts(before, second, "mart_hotel_performance")
    assert [(r.hotel, r.n_rows, r.sum_is_cancelled) for r in parts.collect()] == [("City Hotel", 0, 1)]
    assert I.changed_parts(before, before, "mart_hotel_performance").isEmpty()
    whole = I.mart_parts(first, "mart_hotel_performance")
    gone = whole.unionByName(I.changed_parts(before, before.where("false"), "mart_hotel_performance"))
    assert [r.hotel for r in I.mart_of_parts(gone, "mart_hotel_performance").collect()] == ["Resort Hotel"]
    assert [r.hotel for r in I.compacted_parts(gone, "mart_hotel_performance").collect()] == ["Resort Hotel"]


def test_summed_columns():
    assert summed_columns("mart_simulated_pnl") == ["realized_revenue", "total_nights"]
    assert summed_columns("mart_customer_type_performance")[-1] == "total_guests"


def test_the_stored_state_is_not_shuffled(spark, merged):
    """Only the keys of the new rows move; old and new bookings meet in the state's buckets."""
    store, rows = merged
    state = store.read(STATE)
    fresh = I.state_of(history_frame(spark, rows[:5]))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "4"}
    kept = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        untouched, _ = I.split_state(state, fresh)
        plan = untouched._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(k for k, line in enumerate(lines) if "Join" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join:scan])


def _land(folder, sequence, keys, **values):
    batch = f"batch_{sequence:03d}_x"
    with (folder / f"{batch}.csv").open("w", newline="") as f:
        writer = csv.DictWriter(f, [*BATCH_COLUMNS, *SOURCE_COLUMNS])
        writer.writeheader()
        for i, key in enumerate(keys, 1):
            technical = ["d", i, key, batch, sequence, f"2026-01-{sequence:02d} 00:00:00", i, "initial"]
            writer.writerow(dict(zip(BATCH_COLUMNS, technical)) | source_row(**values))


def test_refresh_reads_new_files_only(spark, tmp_path):
    history, warehouse = new_path(spark, "history"), new_path(spark, "warehouse")
    _land(tmp_path, 1, ["d:1", "d:2", "d:3"])
    ingest(spark, str(tmp_path), history)
    assert refresh_warehouse(spark, history, warehouse, buckets=2) == 1
    assert refresh_warehouse(spark, history, warehouse) == 1  # nothing new
    _land(tmp_path, 2, ["d:2", "d:9"], is_canceled="1", hotel="Resort Hotel")
    ingest(spark, str(tmp_path), history)
    new = read_manifest(spark, history).where("batch_id = 'batch_002_x'").select("source_object_path", "etl_dates")
    plan = rows_of_files(spark, history, new)._jdf.queryExecution().executedPlan().toString()
    assert "20260102" in plan and "20260101" not in plan and "PartitionFilters: [isnotnull(etl_date" in plan
    assert refresh_warehouse(spark, history, warehouse) == 2
    found = open_refreshed(spark, warehouse)
    wanted = fact_of(read_history(spark, history))
    assert ordered(found["fact_bookings"]) == ordered(wanted)
    for name in MARTS:
        assert ordered(found[name]) == ordered(build_mart(wanted, name)), name

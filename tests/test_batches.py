"""Change batches, landing, ingest and load validation, on files."""

from __future__ import annotations

import csv
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows import source_frame, source_row
from stayledger.operators.change_batches import compose_batches, expected_current, with_keys
from stayledger.operators.history import current_state, dedupe_exact, stage
from stayledger.operators.quality import check_suite, multi_state_batches, run_validation
from stayledger.plans.warehouse import build_warehouse
from stayledger.schema import BATCH_COLUMNS, HISTORY_COLUMNS, SOURCE_COLUMNS
from stayledger.session import new_path
from stayledger.sources import batches as B
from stayledger.sources import history as H

N = 14


def source_rows() -> list[dict]:
    return [
        source_row(agent=f"{i:03d}", adr=f"{50 + i}.50", assigned_room_type="ABCDEFGHIH"[i % 10], lead_time=str(i * 20))
        for i in range(1, N + 1)
    ]


@pytest.fixture(scope="module")
def composed(spark):
    source = with_keys(source_frame(spark, source_rows()), "d", ["agent"])
    return compose_batches(source, "d").cache()


@pytest.fixture(scope="module")
def files(composed, tmp_path_factory) -> Path:
    """The five batches as single CSV files, as a producer would deliver them."""
    root = tmp_path_factory.mktemp("batches")
    rows = [r.asDict() for r in composed.collect()]
    for batch in {r["batch_id"] for r in rows}:
        with (root / f"{batch}.csv").open("w", newline="") as f:
            writer = csv.DictWriter(f, [*BATCH_COLUMNS, *SOURCE_COLUMNS])
            writer.writeheader()
            writer.writerows(sorted((r for r in rows if r["batch_id"] == batch), key=lambda r: r["batch_row_number"]))
    return root


@pytest.fixture(scope="module")
def loaded(spark, files) -> str:
    path = new_path(spark, "history")
    assert H.ingest(spark, str(files), path) == N + 34
    return path


def test_batch_sizes_and_operations(composed):
    counts = {(r[0], r[1]): r[2] for r in composed.groupBy("batch_id", "synthetic_operation").count().collect()}
    assert counts == {
        ("batch_001_initial", "initial"): N,
        ("batch_002_updates", "same_state_fixture"): 1,
        ("batch_002_updates", "update"): 9,
        ("batch_002_updates", "new"): 5,
        ("batch_002_updates", "exact_duplicate"): 2,
        ("batch_003_duplicate_replay", "duplicate_replay"): 15,
        ("batch_004_same_state", "same_state_fixture"): 1,
        ("batch_005_reverted_state", "reverted_state_fixture"): 1,
    }


def test_row_changes(composed):
    original = {i: row for i, row in enumerate(source_rows(), 1)}
    updated = {r.batch_row_number: r for r in composed.where("batch_id = 'batch_002_updates'").collect()}
    assert sorted(updated) == list(range(1, 18))
    assert updated[1].adr == original[1]["adr"]
    assert updated[2].adr == f"{float(original[2]['adr']) + 25:.2f}"
    assert updated[5].adr == f"{float(original[5]['adr']) + 15:.2f}"
    assert (updated[6].is_canceled, updated[6].reservation_status) == ("1", "Canceled")
    assert original[8]["assigned_room_type"] == "I" and updated[8].assigned_room_type == "I"
    assert (original[9]["assigned_room_type"], updated[9].assigned_room_type) == ("H", "A")
    assert (original[10]["assigned_room_type"], updated[10].assigned_room_type) == ("A", "B")
    assert updated[10].booking_changes == "1"
    assert updated[11].booking_key == f"d:{N + 1}" and updated[11].adr == f"{float(original[1]['adr']) + 11:.2f}"
    assert updated[16].booking_key == "d:2" and updated[17].booking_key == "d:3"
    assert updated[16].adr == updated[2].adr


def test_history_columns_and_lineage(spark, loaded, files):
    rows = H.read_history(spark, loaded)
    assert rows.columns == HISTORY_COLUMNS and len(HISTORY_COLUMNS) == 50
    row = rows.where("batch_id = 'batch_003_duplicate_replay'").first()
    assert (row.etl_year, row.etl_month, row.etl_day) == (2026, 1, 3)
    assert (row.etl_date, row.raw_batch_sequence) == ("20260103", "003")
    file = files / row.source_file_name
    assert row.file_hash == hashlib.sha256(file.read_bytes()).hexdigest()
    parts = [row.source_object_path, row.booking_key, row.batch_id, str(row.batch_row_number)]
    assert row.row_ingestion_id == hashlib.sha256("||".join(parts).encode()).hexdigest()
    assert row.source_object_path.endswith(f"/{row.source_file_name}")


def test_second_load_adds_nothing(spark, loaded, files):
    assert H.ingest(spark, str(files), loaded) == 0
    assert H.read_history(spark, loaded).count() == N + 34


def test_dedup_and_current_counts(spark, loaded):
    staged = stage(H.read_history(spark, loaded))
    deduped = dedupe_exact(staged)
    current = current_state(deduped).cache()
    assert (deduped.count(), current.count()) == (N + 32, N + 5)
    assert multi_state_batches(staged).count() == 0
    batch = {r.booking_key: r.current_batch_id for r in current.select("booking_key", "current_batch_id").collect()}
    assert batch["d:1"] == "batch_004_same_state" and batch["d:2"] == "batch_005_reverted_state"
    replayed = [f"d:{i}" for i in [*range(3, 11), *range(N + 1, N + 6)]]
    assert {batch[k] for k in replayed} == {"batch_003_duplicate_replay"}
    assert {batch[f"d:{i}"] for i in range(11, N + 1)} == {"batch_001_initial"}


def test_forced_load_doubles_history_only(spark, files):
    path = new_path(spark, "history")
    for _ in range(2):
        assert H.ingest(spark, str(files), path, force=True) == N + 34
    staged = stage(H.read_history(spark, path))
    assert staged.count() == 2 * (N + 34)
    deduped = dedupe_exact(staged)
    assert (deduped.count(), current_state(deduped).count()) == (N + 32, N + 5)


def test_new_batch_is_added_to_old_ones(spark, files, tmp_path):
    path = new_path(spark, "history")
    for name in ("batch_001_initial.csv", "batch_002_updates.csv"):
        (tmp_path / name).write_bytes((files / name).read_bytes())
        H.ingest(spark, str(tmp_path), path)
    counts = {r[0]: r[1] for r in H.batch_counts(H.read_history(spark, path)).collect()}
    assert counts == {"batch_001_initial": N, "batch_002_updates": 17}
    validated = H.load_validation(B.read_batches(spark, str(files)), H.read_history(spark, path)).collect()
    assert {r.batch_id: r.matches for r in validated} == {
        "batch_001_initial": 1,
        "batch_002_updates": 1,
        "batch_003_duplicate_replay": 0,
        "batch_004_same_state": 0,
        "batch_005_reverted_state": 0,
    }
    missing = H.missing_batches(B.list_batch_files(spark, str(files)), H.read_history(spark, path))
    assert sorted(r[0] for r in missing.collect()) == [
        "batch_003_duplicate_replay",
        "batch_004_same_state",
        "batch_005_reverted_state",
    ]


def test_content_validation_finds_what_counts_hide(spark, loaded, files):
    """Changed, swapped, moved and doubled values with equal counts; order and layout do not matter."""
    expected, history = B.read_batches(spark, str(files)), H.read_history(spark, loaded)
    fine = H.content_validation(expected, history.repartition(5, "adr")).collect()
    assert len(fine) == 5 and all(r.matches and r.expected_digest == r.actual_digest for r in fine)
    first = "batch_id LIKE 'batch_001%'"
    price = F.when(F.expr(f"{first} AND agent = '003'"), F.lit("1.00")).otherwise(F.col("adr"))
    pair = {"meal": F.col("country"), "country": F.col("meal")}
    moved = {"meal": F.concat("meal", F.substring("country", 1, 1)), "country": F.expr("substring(country, 2)")}
    one, other = (history.where(f"{first} AND agent = '{a}'") for a in ("001", "002"))
    doubled = history.where(f"NOT ({first} AND agent = '002')").unionByName(one.limit(other.count()))
    for wrong in (history.withColumn("adr", price), history.withColumns(pair), history.withColumns(moved), doubled):
        found = H.content_validation(expected, wrong).collect()
        assert all(r.expected_rows == r.actual_rows for r in found)
        assert [r.batch_id for r in found if not r.matches]
    absent = H.content_validation(expected, history.where("false")).collect()
    assert {(r.actual_rows, r.actual_digest, r.matches) for r in absent} == {(0, "", 0)}
    per_file = H.content_validation(B.with_lineage(expected), history, "source_object_path").collect()
    assert len(per_file) == 5 and all(r.matches for r in per_file)


def test_file_summary(spark, files):
    rows = B.batch_file_summary(B.read_batches(spark, str(files))).collect()
    found = {r.batch_id: (r.batch_sequence, r.etl_date, r.raw_batch_sequence, r.row_count) for r in rows}
    assert found["batch_002_updates"] == (2, "20260102", "002", 17)
    assert len(found) == 5


def test_landing_layout_round_trip(spark, composed):
    root = new_path(spark, "landing")
    for _ in range(2):  # landing again replaces, it does not add
        B.land_batches(composed, root)
    landed = B.read_batch_files(spark, root)
    assert landed.count() == N + 34
    assert landed.exceptAll(composed.select(*[F.col(c).cast("string") for c in landed.columns])).isEmpty()
    paths = [r.path for r in B.list_batch_files(spark, root, B.ANY_CSV).select("path").collect()]
    level = "etl_year=2026/etl_month=01/etl_day=02/raw_batch_sequence=002/batch_file=batch_002_updates.csv/"
    assert any(level in p for p in paths)
    listed = {r[0] for r in B.list_batch_files(spark, root, B.ANY_CSV).select("batch_id").collect()}
    assert listed == {r[0] for r in composed.select("batch_id").distinct().collect()}


def _write(path: Path, rows: list[dict], header: list[str] | None = None) -> None:
    columns = [*BATCH_COLUMNS, *SOURCE_COLUMNS]
    with path.open("w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(header or columns)
        writer.writerows([[row[c] for c in columns] for row in rows])


def _batch_row(**values) -> dict:
    technical = {
        "source_dataset": "d",
        "original_source_row_number": "1",
        "booking_key": "d:1",
        "batch_id": "batch_x",
        "batch_sequence": "1",
        "batch_effective_at": "2026-01-01",
        "batch_row_number": "1",
        "synthetic_operation": "initial",
    }
    return {**technical, **source_row(), **values}


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "other.csv").write_text("x\n")
    with pytest.raises(FileNotFoundError):
        H.ingest(spark, str(tmp_path), new_path(spark, "history"))


def test_wrong_header_is_an_error(spark, tmp_path):
    columns = [*BATCH_COLUMNS, *SOURCE_COLUMNS]
    _write(tmp_path / "batch_x.csv", [_batch_row()], [columns[1], columns[0], *columns[2:]])
    with pytest.raises(Exception, match="(?i)header"):
        H.ingest(spark, str(tmp_path), new_path(spark, "history"))


@pytest.mark.parametrize(
    ("field", "value", "message"),
    [
        ("batch_sequence", "one", "invalid batch_sequence"),
        ("batch_effective_at", "01/02/2026", "unsupported batch_effective_at"),
    ],
)
def test_unreadable_batch_values_stop_the_load(spark, tmp_path, field, value, message):
    _write(tmp_path / "batch_x.csv", [_batch_row(**{field: value})])
    path = new_path(spark, "history")
    with pytest.raises(Exception, match=message):
        H.ingest(spark, str(tmp_path), path)
    assert H.read_history(spark, path).count() == 0


def test_file_without_rows_is_an_error(spark, tmp_path):
    _write(tmp_path / "batch_x.csv", [])
    with pytest.raises(ValueError, match="without data rows"):
        H.ingest(spark, str(tmp_path), new_path(spark, "history"))


def test_empty_file_among_good_ones_leaves_the_table_as_it_was(spark, tmp_path):
    path = new_path(spark, "history")
    _write(tmp_path / "batch_a.csv", [_batch_row(batch_id="batch_a")])
    assert H.ingest(spark, str(tmp_path), path) == 1
    _write(tmp_path / "batch_b.csv", [_batch_row(batch_id="batch_b")])
    _write(tmp_path / "batch_c.csv", [])
    with pytest.raises(ValueError, match="without data rows"):
        H.ingest(spark, str(tmp_path), path)
    assert H.read_history(spark, path).count() == 1 and H.read_manifest(spark, path).count() == 1
    (tmp_path / "batch_c.csv").unlink()
    assert H.ingest(spark, str(tmp_path), path) == 1


def test_further_file_of_a_batch_is_loaded_and_a_changed_one_refused(spark, tmp_path):
    path = new_path(spark, "history")
    _write(tmp_path / "batch_a.csv", [_batch_row(batch_id="batch_a")])
    assert H.ingest(spark, str(tmp_path), path) == 1
    _write(tmp_path / "batch_a2.csv", [_batch_row(batch_id="batch_a", booking_key=f"d:{k}") for k in (2, 3)])
    assert H.ingest(spark, str(tmp_path), path) == 2
    assert H.batch_counts(H.read_history(spark, path)).first()[1] == 3
    record = {r.source_object_path.rsplit("/", 1)[-1]: r for r in H.read_manifest(spark, path).collect()}
    second = record["batch_a2.csv"]
    assert (second.row_count, second.batch_id) == (2, "batch_a")
    assert second.file_hash == hashlib.sha256((tmp_path / "batch_a2.csv").read_bytes()).hexdigest()
    _write(tmp_path / "batch_a.csv", [_batch_row(batch_id="batch_a", hotel="another one")])
    with pytest.raises(ValueError, match="changed since"):
        H.ingest(spark, str(tmp_path), path)


def test_load_that_lost_its_record_is_completed_not_repeated(spark, tmp_path):
    path = new_path(spark, "history")
    _write(tmp_path / "batch_a.csv", [_batch_row(batch_id="batch_a")])
    files = B.list_batch_files(spark, str(tmp_path))
    H.create_history(spark, path)
    H.append_history(B.history_rows(spark, [r.path for r in files.collect()]), path)  # and then the run ended
    assert H.ingest(spark, str(tmp_path), path) == 0
    assert H.read_history(spark, path).count() == 1 and H.read_manifest(spark, path).count() == 1


@pytest.mark.parametrize("sequence", ["999", "1000", "12345"])
def test_long_batch_sequences_stay_whole(spark, tmp_path, sequence):
    _write(tmp_path / "batch_a.csv", [_batch_row(batch_sequence=sequence)])
    path = new_path(spark, "history")
    H.ingest(spark, str(tmp_path), path)
    rows = H.read_history(spark, path)
    assert rows.first().raw_batch_sequence == sequence
    assert stage(rows.withColumn("raw_batch_sequence", F.lit(None).cast("string"))).first().raw_batch_sequence == sequence


def test_batch_id_falls_back_to_file_stem_and_quotes_survive(spark, tmp_path):
    _write(tmp_path / "batch_y.csv", [_batch_row(batch_id="", hotel='The "Old", Inn', batch_effective_at="2026-01-01T10:00:00")])
    path = new_path(spark, "history")
    assert H.ingest(spark, str(tmp_path), path) == 1
    row = H.read_history(spark, path).first()
    assert (row.batch_id, row.hotel, row.batch_effective_at.hour) == ("batch_y", 'The "Old", Inn', 10)


def test_run_validation_and_suite_on_loaded_batches(spark, loaded):
    relations = build_warehouse(H.read_history(spark, loaded))
    assert run_validation(relations, expected_current("d")).where("passed = 0").count() == 0
    suite = check_suite(relations, expected_current("d")).collect()
    failed = {(r.check_name, r.column_name) for r in suite if r.failures and r.severity == "error"}
    assert failed == set()
    wrong = run_validation(relations, {"d:1": "batch_001_initial", "d:999": "batch_001_initial"})
    assert sorted(r.subject for r in wrong.where("passed = 0").collect()) == ["d:1", "d:999"]

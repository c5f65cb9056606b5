"""What landing, loads and merges leave on disk and move between tasks."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows import source_row
from stayledger.operators.ordering import number_rows, number_rows_in_place
from stayledger.plans import registry
from stayledger.schema import BATCH_COLUMNS, SOURCE_COLUMNS
from stayledger.session import new_path, scratch
from stayledger.sources import batches as B
from stayledger.sources import history as H

FOLDER = "/root/testdata/sf0.001"
has_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not there")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_files_are_compressed_and_read_back(spark):
    row = {**dict.fromkeys(BATCH_COLUMNS, "1"), "batch_id": "", "batch_effective_at": "2026-01-01 00:00:00", **source_row()}
    columns = [*BATCH_COLUMNS, *SOURCE_COLUMNS]
    texts = [[row[c] if c != "hotel" else f'The "{k}", Inn ' for c in columns] for k in range(200)]
    rows = spark.createDataFrame(texts, ", ".join(f"{c} string" for c in columns)).coalesce(1)
    root = new_path(spark, "landing")
    B.land_batches(rows.withColumn("batch_id", F.lit("b")), root)
    files = B.list_batch_files(spark, root, B.ANY_CSV).collect()
    assert [f.batch_id for f in files] == ["b"] and files[0].path.endswith(".csv.gz")
    assert files[0].file_bytes * 5 < sum(len(",".join(t)) for t in texts)
    assert B.read_batch_files(spark, root).select("hotel").exceptAll(rows.select("hotel")).isEmpty()
    path = new_path(spark, "history")
    assert H.ingest(spark, root, path, pattern=B.ANY_CSV) == 200
    found = H.read_history(spark, path)
    assert found.inputFiles()[0].endswith(".zstd.parquet")
    hashed = hashlib.sha256(Path(files[0].path.removeprefix("file:")).read_bytes()).hexdigest()
    assert {r.file_hash for r in found.select("file_hash").collect()} == {hashed}


def test_a_compressed_delivery_is_named_by_its_stem(spark, tmp_path):
    (tmp_path / "batch_z.csv.gz").write_bytes(gzip.compress(b"a\n1\n"))
    assert [r.batch_id for r in B.list_batch_files(spark, str(tmp_path), B.ANY_CSV).collect()] == ["batch_z"]


def test_rows_are_numbered_where_they_lie(spark):
    rows = spark.createDataFrame([(k * 7 % 11, k, "x" * 40) for k in range(60)], "a int, b int, wide string")
    ours = number_rows_in_place(rows.repartition(4, "a"), "a", ["a", "b"], "n")
    wanted = {r.b: r.n for r in number_rows(rows, ["a", "b"], "n").collect()}
    assert {r.b: r.n for r in ours.collect()} == wanted and sorted(wanted.values()) == list(range(1, 61))
    with pytest.raises(Exception, match="a is empty"):
        with_null = rows.unionByName(rows.limit(1).withColumn("a", F.lit(None).cast("int")))
        number_rows_in_place(with_null, "a", ["a", "b"], "n").collect()
    with pytest.raises(ValueError, match="begin with b"):
        number_rows_in_place(rows, "b", ["a", "b"], "n")


@has_tables
def test_lines_are_not_moved_to_be_numbered(spark, monkeypatch):
    seen = []
    stored = registry.materialize
    monkeypatch.setattr(registry, "materialize", lambda df, *a: seen.append(_plan(df)) or stored(df, *a))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        registry.change_batches(spark, FOLDER)
    finally:
        spark.conf.set(name, before)
    moved = [line for line in seen[0].splitlines() if "Exchange hashpartitioning" in line]
    assert len(seen) == 1 and "l_quantity" in seen[0] and "rangepartitioning" not in seen[0]
    assert len(moved) == 3 and not any("l_linenumber" in line for line in moved)  # slices, totals, starts of orders


@has_tables
@pytest.mark.parametrize("name", ["ingest_lineage", "ingest_current", "ingest_forced", "ingest_idempotent", "ingest_late_files"])
def test_loads_leave_the_history_only(spark, name):
    with scratch(spark) as work:
        getattr(registry, {"ingest_current": "ingested_current"}.get(name, name))(spark, FOLDER)
        left = {p.name.split("-")[0] for p in Path(work).iterdir() if p.is_dir() and any(p.rglob("*.*"))}
    assert left == {"history"}


@has_tables
def test_content_validation_joins_the_tables_once(spark, monkeypatch):
    joined = []
    for name in ("star_lines", "star_history"):
        made = getattr(registry, name)
        monkeypatch.setattr(registry, name, lambda *a, made=made: joined.append(1) or made(*a))
    found = registry.validated_content(spark, FOLDER).collect()
    assert len(joined) == 1 and len(found) == 3 and all(r.matches and r.expected_digest for r in found)

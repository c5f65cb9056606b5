"""Landed files stay small, and rows move while they are narrow."""

from __future__ import annotations

from pathlib import Path

import pytest

from rows import source_row
from stayledger.plans import registry
from stayledger.schema import BATCH_COLUMNS, SOURCE_COLUMNS
from stayledger.session import new_path
from stayledger.sources import batches as B

FOLDER = "/root/testdata/sf0.001"


def test_a_task_lands_a_large_batch_as_several_files(spark):
    row = {**dict.fromkeys(BATCH_COLUMNS, "1"), "batch_id": "b", "batch_effective_at": "2026-01-01 00:00:00", **source_row()}
    columns = [*BATCH_COLUMNS, *SOURCE_COLUMNS]
    rows = spark.createDataFrame([[row[c] for c in columns]] * 25, ", ".join(f"{c} string" for c in columns)).coalesce(1)
    root = new_path(spark, "landing")
    B.land_batches(rows, root, file_rows=10)
    sizes = B.read_batch_files(spark, root).groupBy("_metadata.file_path").count().collect()
    assert sorted(r["count"] for r in sizes) == [5, 10, 10]
    hashed = B.file_hashes(spark, [r.path for r in B.list_batch_files(spark, root, B.ANY_CSV).select("path").collect()])
    assert {len(r.file_hash) for r in hashed.collect()} == {64} and hashed.count() == 3


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not there")
def test_lines_are_numbered_and_stored_before_they_are_spelled_out(spark, monkeypatch):
    moved = []
    keyed, stored = registry.with_keys, registry.materialize
    monkeypatch.setattr(registry, "with_keys", lambda rows, *a: moved.append(rows) or keyed(rows, *a))
    monkeypatch.setattr(registry, "materialize", lambda rows, *a: moved.append(rows) or stored(rows, *a))
    registry.change_batches(spark, FOLDER)
    registry._star_batches(spark, FOLDER)
    registry._deliveries(spark, FOLDER)
    assert len(moved) == 4
    assert not any(set(rows.columns) & set(SOURCE_COLUMNS) for rows in moved)

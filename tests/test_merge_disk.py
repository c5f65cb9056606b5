"""Merges keep their last state only."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from stayledger.plans import registry
from stayledger.session import scratch

FOLDER = "/root/testdata/sf0.001"
has_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not there")


@has_tables
def test_merges_leave_the_last_state_only(spark):
    with scratch(spark) as work:
        registry.current_incremental(spark, FOLDER)
        left = [p for p in Path(work).iterdir() if any(p.rglob("*.parquet"))]
        assert [p.name.split("-")[0] for p in left] == ["refreshed"]
        states = list((left[0] / "state").iterdir())
        assert len(states) == 1
        assert all(re.search(r"\.zstd\.parquet$", p.name) for p in states[0].glob("*.parquet"))

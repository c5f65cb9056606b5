"""The driver's entry works with and without the training-data operators."""

from __future__ import annotations

import importlib
import sys

import pytest


@pytest.mark.parametrize("missing", ["corpus_pipeline", "stayledger.llm", None])
def test_entry(monkeypatch, missing):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("stayledger.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    if missing:
        monkeypatch.setitem(sys.modules, missing, None)
    entry = importlib.import_module("__spark_entry__")
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and "mart_hotel_performance" in queries
    if missing:
        assert entry._llm is None and "pipeline" not in queries
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)

"""Merging deliveries moves wide rows once."""

from __future__ import annotations

from rows import history_frame, history_row
from stayledger.operators.incremental import state_of
from stayledger.plans import registry
from stayledger.plans.refresh import STATE, merge_rows
from stayledger.session import new_path
from stayledger.sources.versions import Versions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_are_dealt_once_per_merge(spark, monkeypatch):
    written = []
    write = Versions.write_bucketed
    monkeypatch.setattr(Versions, "write_bucketed", lambda self, n, parts, *a: written.append([_plan(p) for p in parts]) or write(self, n, parts, *a))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        store = Versions(spark, new_path(spark, "merged"))
        for keys in (range(6), range(3, 8)):
            version, tables = store.current()
            rows = history_frame(spark, [history_row(key=f"d:{k}", row=k) for k in keys])
            store.commit(merge_rows(store, tables, rows, 4, ["mart_hotel_performance"]), on=version)
    finally:
        spark.conf.set(threshold, before)
    assert [[text.count("Exchange") for text in parts] for parts in written] == [[1], [1], [0, 1]]
    assert store.read(STATE).count() == 8


def test_buckets_follow_the_session(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(registry, "_deliveries", lambda *_: [history_frame(spark, [history_row(key="d:1", row=1)])])
    monkeypatch.setattr(registry, "merge_rows", lambda s, t, r, b, m: seen.append(b) or merge_rows(s, t, r, b, m))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        registry.current_incremental(spark, "")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == [5]


def test_state_with_buckets_is_the_state(spark):
    rows = history_frame(spark, [history_row(key=f"d:{k % 3}", row=k) for k in range(6)])
    assert state_of(rows, 3).exceptAll(state_of(rows)).isEmpty()
    assert state_of(rows).exceptAll(state_of(rows, 3)).isEmpty()

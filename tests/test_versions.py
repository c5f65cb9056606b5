"""Versioned tables: switches as a whole, readers that survive, expiry by age."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from rows import history_frame, history_row
from stayledger.operators.marts import build_mart
from stayledger.operators.saved import expire_saved, refresh, save_aggregate, saved_version
from stayledger.plans.warehouse import metrics_of, open_warehouse, plan_warehouse, store_warehouse
from stayledger.session import new_path
from stayledger.sources.versions import VersionConflict, Versions

LATER = datetime.now(timezone.utc) + timedelta(days=9)


@pytest.fixture
def store(spark):
    return Versions(spark, new_path(spark, "versions"))


def test_a_commit_switches_all_tables(spark, store):
    first = {n: store.write(n, spark.range(k)) for n, k in (("a", 1), ("b", 2))}
    assert store.current() == (0, {})
    assert store.commit(first) == 1
    opened = store.read("a")
    assert store.commit({"a": store.write("a", spark.range(10))}) == 2
    assert (opened.count(), store.read("a").count(), store.read("b").count()) == (1, 10, 2)
    assert store.read("a", 1).count() == 1 and [n for n, _ in store.log()] == [1, 2]
    assert store.restore(1) == 3 and store.read("a").count() == 1
    store.commit({"b": None})
    assert set(store.tables()) == {"a"}
    with pytest.raises(KeyError):
        store.tables(77)


def test_commits_do_not_undo_each_other(spark, store):
    other = Versions(spark, store.root)
    store.commit({"a": store.write("a", spark.range(1))})
    seen, _ = other.current()
    store.commit({"a": store.write("a", spark.range(2))})
    with pytest.raises(VersionConflict):
        other.commit({"a": other.write("a", spark.range(3))}, on=seen)
    other.commit({"b": other.write("b", spark.range(4))})
    assert (store.read("a").count(), store.read("b").count()) == (2, 4)


def test_a_record_half_written_is_not_read(spark, store):
    store.commit({"a": store.write("a", spark.range(1))})
    assert store._create(store._record_path(2), b'{"tables": {"a"')
    assert store.current()[0] == 1
    assert not store._create(store._record_path(2), b"{}")
    assert store.commit({"a": store.write("a", spark.range(5))}) == 3
    assert store.read("a").count() == 5


def test_expiry_goes_by_age_and_keeps_what_is_named(spark, store):
    for rows in (1, 2, 3):
        store.commit({"a": store.write("a", spark.range(rows))})
    store.write("a", spark.range(9))  # not committed yet
    assert store.expire(timedelta(days=1)) == []
    removed = store.expire(timedelta(days=1), now=LATER)
    assert len(removed) == 3 and [n for n, _ in store.log()] == [3]
    assert store.read("a").count() == 3


def test_bucketed_tables_need_no_shuffle(spark, store):
    rows = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    entry = store.write_bucketed("t", [rows.where("v < 50"), rows.where("v >= 50")], ["k"], 4)
    store.commit({"t": entry})
    found = store.read("t")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
    plan = found.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("t__", "opened__"))]


@pytest.fixture(scope="module")
def facts(spark):
    rows = [history_row(key="d:1"), history_row(key="d:2", hotel="Resort Hotel", is_canceled="1")]
    return metrics_of(history_frame(spark, rows)).cache()


def test_a_reader_survives_two_refreshes(spark, facts):
    warehouse = new_path(spark, "warehouse")
    opened = refresh(facts, "saved_hotel", warehouse)
    for _ in range(2):
        refresh(facts.where("hotel = 'City Hotel'"), "saved_hotel", warehouse)
    assert opened.count() == 2 and spark.table("saved_hotel").count() == 1
    assert saved_version(spark, "saved_hotel", 1, warehouse).count() == 2
    assert expire_saved(spark, timedelta(days=1), warehouse) == []
    assert saved_version(spark.newSession(), "saved_hotel", warehouse=warehouse).count() == 1


def test_a_failed_refresh_changes_nothing(spark, facts):
    warehouse = new_path(spark, "warehouse")
    mart = build_mart(facts, "mart_hotel_performance")
    save_aggregate(mart, "kept_name", ["hotel"], 2, warehouse)
    broken = mart.selectExpr("*", "raise_error('stop') AS x").drop("x").selectExpr("hotel", "assert_true(bookings < 0) AS y")
    with pytest.raises(Exception):  # noqa: B017
        save_aggregate(broken, "kept_name", ["hotel"], 2, warehouse)
    assert spark.table("kept_name").count() == 2
    assert len(Versions(spark, f"{warehouse}/saved").log()) == 1


def test_a_name_of_another_shape_is_replaced(spark, facts):
    warehouse = new_path(spark, "warehouse")
    mart = build_mart(facts, "mart_hotel_performance")
    save_aggregate(mart, "other_shape", ["hotel"], 2, warehouse)
    again = save_aggregate(mart.select("hotel", "bookings"), "other_shape", ["hotel"], 3, warehouse)
    assert again.columns == ["hotel", "bookings"] and again.count() == 2


def test_the_warehouse_is_published_as_a_whole(spark):
    warehouse = new_path(spark, "warehouse")
    relations = plan_warehouse(history_frame(spark, [history_row(key="d:1")]))
    assert store_warehouse(relations, warehouse) == 1
    opened = open_warehouse(spark, warehouse)
    broken = relations | {"mart_simulated_pnl": relations["mart_simulated_pnl"].selectExpr("raise_error('stop') AS x")}
    with pytest.raises(Exception):  # noqa: B017
        store_warehouse(broken, warehouse)
    assert store_warehouse(plan_warehouse(history_frame(spark, [history_row(key=f"d:{k}") for k in range(4)])), warehouse) == 2
    assert opened["fact_bookings"].count() == 1
    assert open_warehouse(spark, warehouse)["fact_bookings"].count() == 4
    assert open_warehouse(spark, warehouse, 1)["saved_hotel"].first()["bookings"] == 1

"""Plans keep the shape they need at scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from rows import history_frame, history_row
from stayledger.operators.charts import CHARTS, chart_query
from stayledger.operators.history import dedupe_exact, latest_per_key, stage
from stayledger.operators.marts import build_mart
from stayledger.operators.metrics import booking_metrics, fact_bookings
from stayledger.operators.quality import check_suite, multi_state_batches, run_validation
from stayledger.plans.registry import all_queries
from stayledger.plans.warehouse import build_warehouse, fact_of
from stayledger.session import broadcast_if_small, cluster_conf, materialize, new_path
from stayledger.sources.star import star_history

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not there")

#: Queries that run jobs of their own while they are built.
EAGER = re.compile("saved|reconcile|check_suite|run_validation|object_counts|ingest|landed|change|absent|price|incremental")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def history(spark):
    return materialize(star_history(spark, FOLDER), "history")


@pytest.mark.parametrize("name", [n for n in all_queries() if not EAGER.search(n)])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(all_queries()[name](spark, FOLDER))
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_each_window_reduces_before_its_shuffle(history):
    """Read upwards: partial limit, exchange, final limit, twice."""
    text = plan(latest_per_key(dedupe_exact(stage(history))))
    steps = re.findall(r"WindowGroupLimit.*?(Partial|Final)|(Exchange) hashpartitioning", text)
    assert [a or b for a, b in steps] == ["Final", "Exchange", "Partial"] * 2


def test_mart_over_stored_bookings_reads_its_columns_only(spark, history):
    current = build_warehouse(history)["current_bookings"]
    text = plan(build_mart(fact_bookings(booking_metrics(current)), "mart_channel_performance"))
    columns = set(re.findall(r"(\w+)#", re.search(r"FileScan parquet [\w.]*\[(.*?)\]", text).group(1)))
    assert columns == {"is_canceled", "stays_in_weekend_nights", "stays_in_week_nights", "distribution_channel", "adr"}
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text


def test_filters_reach_the_scan(history):
    text = plan(history.where("etl_date is null and booking_key = 'x'").select("batch_id"))
    assert "EqualTo(booking_key,x)" in text


def test_required_dates_filter_before_the_aggregate(history):
    text = plan(build_mart(fact_of(history), "mart_daily_booking_revenue"))
    assert text.count("Exchange hashpartitioning") == 3


def test_top_k_is_one_operator(history):
    chart = CHARTS["chart_countries_by_bookings"]
    assert "TakeOrderedAndProject" in plan(chart_query(build_mart(fact_of(history), chart.mart), chart))


def test_distinct_states_are_counted_in_partial_steps(history):
    text = plan(multi_state_batches(stage(history)))
    assert text.count("partial_count(distinct") == 1


def test_broadcast_depends_on_the_counted_size(spark):
    df = spark.range(10)

    def hinted(side):
        return "hint" in side._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(df, rows=10)) and not hinted(broadcast_if_small(df, rows=10**9))


def test_cluster_settings_grow_with_the_input():
    small, large = cluster_conf(10**9), cluster_conf(100 * 10**12)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert 50_000 < int(large["spark.sql.shuffle.partitions"]) < 200_000


def test_checks_run_bucket_by_bucket(spark):
    """The whole suite with known current bookings: 94 lines, and no more than four shuffles by hash."""
    rows = [history_row(key=f"d:{k}", row=k) for k in range(6)]
    relations = build_warehouse(history_frame(spark, rows), new_path(spark, "warehouse"))
    suite = check_suite(relations, {"d:1": "b1", "d:2": "b1"})
    text = plan(suite)
    assert text.count("Exchange hashpartitioning") <= 4
    found = suite.collect()
    assert len(found) == 94
    assert {r.column_name: r.failures for r in found if r.check_name == "current_batch"} == {"d:1": 0, "d:2": 0}
    validated = plan(run_validation(relations))
    assert validated.count("Exchange hashpartitioning") <= 4

"""The command-line jobs and SQL over the published relations."""

from __future__ import annotations

import csv
from pathlib import Path

from rows import source_row
from stayledger.__main__ import main
from stayledger.operators.charts import CHARTS, chart_query
from stayledger.plans.warehouse import build_warehouse, open_warehouse, publish
from stayledger.schema import BATCH_COLUMNS, SOURCE_COLUMNS
from stayledger.session import new_path
from stayledger.sources.history import read_history


def _batch(folder, count: int) -> None:
    with (folder / "batch_001_initial.csv").open("w", newline="") as f:
        writer = csv.DictWriter(f, [*BATCH_COLUMNS, *SOURCE_COLUMNS])
        writer.writeheader()
        for i in range(1, count + 1):
            technical = ["d", i, f"d:{i}", "batch_001_initial", 1, "2026-01-01 00:00:00", i, "initial"]
            hotel = "City Hotel" if i % 3 else "Resort Hotel"
            row = source_row(hotel=hotel, is_canceled=str(i % 2), adr=f"{i}.00")
            writer.writerow(dict(zip(BATCH_COLUMNS, technical)) | row)


def test_jobs(spark, tmp_path, capsys):
    _batch(tmp_path, 9)
    history = new_path(spark, "history")
    assert main(["ingest", str(tmp_path), history]) == 0
    assert "appended 9 rows" in capsys.readouterr().out
    assert main(["ingest", str(tmp_path), history]) == 0
    assert "appended 0 rows" in capsys.readouterr().out
    assert main(["build", history, new_path(spark, "warehouse")]) == 0
    assert main(["profile", str(tmp_path)]) == 0
    assert "mean_price" in capsys.readouterr().out


def test_built_tables_are_found_by_another_session(spark, tmp_path):
    _batch(tmp_path, 9)
    history, warehouse = new_path(spark, "history"), new_path(spark, "warehouse")
    main(["ingest", str(tmp_path), history])
    assert main(["build", history, warehouse]) == 0
    found = open_warehouse(spark.newSession(), warehouse)
    assert found["fact_bookings"].count() == 9
    assert found["saved_hotel"].agg({"bookings": "sum"}).first()[0] == 9
    assert not [p for p in Path(spark.sparkContext.getConf().get("spark.checkpoint.dir")).glob("job-*")]


def test_build_reports_errors(spark, tmp_path):
    _batch(tmp_path, 3)
    text = (tmp_path / "batch_001_initial.csv").read_text().replace("March", "Marsh")
    (tmp_path / "batch_001_initial.csv").write_text(text)
    history = new_path(spark, "history")
    main(["ingest", str(tmp_path), history])
    assert main(["build", history, new_path(spark, "warehouse")]) == 1


def test_sql_over_published_relations(spark, tmp_path):
    _batch(tmp_path, 9)
    history = new_path(spark, "history")
    main(["ingest", str(tmp_path), history])
    relations = build_warehouse(read_history(spark, history))
    publish(relations, {"saved_hotel": "mv_hotel_performance"})
    share = spark.sql(
        "SELECT SUM(cancelled_bookings) / NULLIF(SUM(bookings), 0) AS r FROM mart_hotel_performance"
    ).first()[0]
    chart = chart_query(relations["mart_hotel_performance"], CHARTS["chart_cancellation_rate"]).first()[0]
    assert share == chart == 5 / 9
    counted = spark.sql(
        "SELECT batch_id, COUNT(*) AS row_count FROM staged_history GROUP BY batch_id ORDER BY batch_id"
    ).collect()
    assert [tuple(r) for r in counted] == [("batch_001_initial", 9)]
    for name in ("mv_hotel_performance", "saved_hotel"):
        assert spark.sql(f"SELECT SUM(bookings) FROM {name}").first()[0] == 9

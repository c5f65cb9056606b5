"""Saved aggregates: marts stored as bucketed tables in versions, refreshed in full."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators.marts import build_mart
from stayledger.sources.versions import Versions


@dataclass(frozen=True)
class Saved:
    """A mart to store, its distribution keys and bucket count, and the totals to reconcile."""

    mart: str
    keys: list[str]
    buckets: int
    totals: list[str]


# The three saved aggregates.
SAVED: dict[str, Saved] = {
    "saved_daily": Saved(
        "mart_daily_booking_revenue", ["arrival_date"], 8, ["total_bookings", "realized_revenue"]
    ),
    "saved_monthly": Saved(
        "mart_monthly_booking_revenue",
        ["year_number", "month_number"],
        4,
        ["total_bookings", "realized_revenue"],
    ),
    "saved_hotel": Saved("mart_hotel_performance", ["hotel"], 2, ["bookings", "realized_revenue"]),
}


def _drop(spark: SparkSession, name: str) -> None:
    """Drop whatever object has that name: a temporary view, a view or a table."""
    spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {name}")


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _same_shape(spark: SparkSession, name: str, other: str) -> bool:
    """Whether a name is a stored table with the columns and buckets of the other."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "EXTERNAL":
        return False
    a, b = _described(spark, name), _described(spark, other)
    buckets = ("Num Buckets", "Bucket Columns", "Provider")
    return all(a.get(k) == b.get(k) for k in buckets) and spark.table(name).schema == spark.table(other).schema


def _point(spark: SparkSession, name: str, fresh: str, folder: str) -> None:
    """Let ``name`` mean the table just written.

    A table of the same shape gets the new folder in one change of the catalog, so the name is
    always there. Only a name that meant something else is dropped first."""
    if _same_shape(spark, name, fresh):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"DROP TABLE {fresh}")  # the files of an external table stay
        spark.catalog.refreshTable(name)
        return
    _drop(spark, name)
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def _versions(spark: SparkSession, warehouse: str | None) -> Versions:
    return Versions(spark, f"{(warehouse or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/saved")


def save_aggregate(
    df: DataFrame, name: str, keys: list[str], buckets: int, warehouse: str | None = None
) -> DataFrame:
    """Store ``df`` as a table hash-distributed by ``keys`` and return a scan of it.

    Each refresh writes a version in ``warehouse`` (by default the session's warehouse folder,
    not the folder for intermediate data), records it, and lets the name mean it once all is
    written. A failed refresh changes nothing. Readers of earlier versions keep them:
    a refresh removes nothing, ``expire_saved`` does, by age.
    """
    spark = df.sparkSession
    store = _versions(spark, warehouse)
    fresh, folder = f"{name}__{uuid.uuid4().hex}", store.new_folder(name)
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .format("parquet")
        .option("path", folder)
        .saveAsTable(fresh)
    )
    store.commit({name: {"folders": [folder], "schema": df.schema.jsonValue(), "keys": keys, "buckets": buckets}})
    _point(spark, name, fresh, folder)
    return spark.table(name)


def saved_version(spark: SparkSession, name: str, version: int | None = None, warehouse: str | None = None) -> DataFrame:
    """A saved aggregate as of a version, in any session; by default the newest."""
    return _versions(spark, warehouse).read(name, version)


def expire_saved(spark: SparkSession, older_than: timedelta, warehouse: str | None = None) -> list[str]:
    """Remove versions older than ``older_than``, never the newest; returns the folders removed."""
    return _versions(spark, warehouse).expire(older_than)


def refresh(fact: DataFrame, name: str, warehouse: str | None = None) -> DataFrame:
    """Recompute one saved aggregate from the fact and store it."""
    return save_mart(build_mart(fact, SAVED[name].mart), name, warehouse)


def save_mart(mart: DataFrame, name: str, warehouse: str | None = None) -> DataFrame:
    """Store a saved aggregate from its mart, which holds the same rows."""
    spec = SAVED[name]
    return save_aggregate(mart, name, spec.keys, spec.buckets, warehouse)


def reconcile(saved: DataFrame, recomputed: DataFrame, name: str) -> DataFrame:
    """Totals of a saved aggregate that differ from the recomputed mart, exactly compared."""
    totals = SAVED[name].totals

    def sums(df: DataFrame, sign: int) -> DataFrame:
        return df.agg(*[(F.coalesce(F.sum(t), F.lit(0)) * sign).alias(t) for t in totals])

    both = sums(saved, 1).unionByName(sums(recomputed, -1)).agg(*[F.sum(t).alias(t) for t in totals])
    lines = [
        F.struct(F.lit(t).alias("metric_name"), F.col(t).cast("decimal(38,2)").alias("diff_value")) for t in totals
    ]
    return (
        both.select(F.inline(F.array(*lines)))
        .where(F.col("diff_value") != 0)
        .select(F.lit(name).alias("saved_name"), "metric_name", "diff_value")
    )

"""The append-only history table: Parquet, partitioned by load date."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stayledger.functions.hashing import content_number
from stayledger.schema import HISTORY_COLUMNS, HISTORY_PARTITION, HISTORY_SCHEMA, SOURCE_COLUMNS
from stayledger.session import TEXT_CODEC, materialize
from stayledger.sources.batches import BATCH_GLOB, history_rows, list_batch_files, read_batch_files, with_lineage

_LOG = logging.getLogger(__name__)

MANIFEST_SCHEMA = (
    "source_object_path string, file_bytes long, file_hash string, batch_id string, row_count long, loaded_at timestamp, "
    "etl_dates array<string>"
)


def create_history(spark: SparkSession, path: str) -> None:
    """Create the table's folder unless it exists."""
    empty = spark.createDataFrame([], HISTORY_SCHEMA)
    empty.write.mode("ignore").partitionBy(HISTORY_PARTITION).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history under its declared schema.

    The schema is not inferred: files written before a column was added give
    NULL for it, columns that were dropped are not read, and ``etl_date`` stays
    text although it looks like a number.
    """
    return spark.read.schema(HISTORY_SCHEMA).parquet(path).select(*HISTORY_COLUMNS)


def align_history(df: DataFrame) -> DataFrame:
    """Any older layout as the declared one: missing columns added, extra ones dropped."""
    empty = df.sparkSession.createDataFrame([], HISTORY_SCHEMA)
    return empty.unionByName(
        df.select(*[c for c in df.columns if c in HISTORY_COLUMNS]), allowMissingColumns=True
    )


def append_history(rows: DataFrame, path: str) -> int:
    """Append rows and return how many, counted while they are written."""
    load = Observation()
    counted = rows.select(*HISTORY_COLUMNS).observe(load, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").partitionBy(HISTORY_PARTITION).option("compression", TEXT_CODEC).parquet(path)
    return load.get["rows"]


def manifest_path(path: str) -> str:
    """The record of loaded files stands beside the history."""
    return f"{path.rstrip('/')}_loads"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per loaded file: path, bytes, hash, batch, rows and load time."""
    spark.createDataFrame([], MANIFEST_SCHEMA).write.mode("ignore").parquet(manifest_path(path))
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path(path))


def without_loaded(files: DataFrame, path: str) -> DataFrame:
    """Files that the manifest does not list. The history itself is not read."""
    known = read_manifest(files.sparkSession, path).select("source_object_path")
    return files.join(known, "source_object_path", "left_anti")


def ingest(
    spark: SparkSession, root: str, path: str, force: bool = False, pattern: str = BATCH_GLOB
) -> int:
    """Load all batch files under ``root`` into the history; returns rows appended.

    A file that was loaded is skipped unless ``force``; a further file of a
    loaded batch is loaded. One write job loads all remaining files.
    """
    create_history(spark, path)
    return load_files(list_batch_files(spark, root, pattern), path, force)


def load_files(files: DataFrame, path: str, force: bool = False) -> int:
    """Load listed files; see ``ingest``.

    Files are counted, and their batch columns read, before anything is
    written, so an unreadable or empty file leaves the table as it was. Then the
    rows that arrived are compared with that count, file by file, in the load
    dates just written. A run that ended between the commit of its rows and of
    its record is completed, not repeated.
    """
    spark = files.sparkSession
    started = datetime.now(timezone.utc)
    known = read_manifest(spark, path)
    if not force:
        sizes = known.select("source_object_path", F.col("file_bytes").alias("loaded_bytes"))
        changed = files.join(sizes, "source_object_path").where("file_bytes <> loaded_bytes")
        _refuse(changed, "files changed since they were loaded")
    pending = materialize(files if force else without_loaded(files, path), "pending_files")
    # Only the file listing comes to the driver, where a scan's listing is held anyway.
    paths = [row["path"] for row in pending.select("path").collect()]
    if not paths:
        return 0
    counts = materialize(
        with_lineage(read_batch_files(spark, paths))
        .groupBy("source_object_path", "batch_id", "etl_date")
        .agg(F.count(F.lit(1)).alias("row_count")),
        "pending_rows",
    )
    _refuse(files_without_rows(pending, counts), "batch files without data rows")
    again = counts.select("batch_id").distinct().join(known.select("batch_id"), "batch_id", "left_semi")
    if names := [row[0] for row in again.take(5)]:
        _LOG.warning("further files of batches that are loaded: %s", names)
    expected = counts.groupBy("source_object_path").agg(F.sum("row_count").alias("expected_rows"))
    dates = [row[0] for row in counts.select("etl_date").distinct().collect()]

    def arrived() -> DataFrame:
        rows = read_history(spark, path).where(F.col("etl_date").isin(dates))
        return rows if not force else rows.where(F.col("ingested_at") >= F.lit(started))

    found = _arrivals(arrived(), expected)
    _refuse(found.where("rows_found <> expected_rows"), "files loaded in part by an earlier run")
    found = materialize(found, "found_files")
    appended = 0
    fresh = pending.join(found, "source_object_path", "left_anti")
    if paths := [row["path"] for row in fresh.select("path").collect()]:
        appended = append_history(history_rows(spark, paths), path)
        loaded = _arrivals(arrived(), expected)
        short = expected.join(loaded.drop("expected_rows"), "source_object_path", "left")
        _refuse(short.where("rows_found IS NULL OR rows_found <> expected_rows"), "rows missing after the load")
        found = loaded
    record = found.join(pending.select("source_object_path", "file_bytes"), "source_object_path").select(
        "source_object_path",
        "file_bytes",
        "file_hash",
        "batch_id",
        F.col("rows_found").alias("row_count"),
        F.current_timestamp().alias("loaded_at"),
        "etl_dates",
    )
    record.write.mode("append").parquet(manifest_path(path))
    return appended


def _arrivals(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows, batch, hash and load dates of the expected files that the history rows have."""
    per_file = rows.groupBy("source_object_path").agg(
        F.count(F.lit(1)).alias("rows_found"),
        F.min("batch_id").alias("batch_id"),
        F.min("file_hash").alias("file_hash"),
        F.collect_set("etl_date").alias("etl_dates"),
    )
    return per_file.join(expected, "source_object_path")


def _refuse(files: DataFrame, why: str) -> None:
    if bad := files.select("source_object_path").take(5):
        raise ValueError(f"{why}: {[row[0].rsplit('/', 1)[-1] for row in bad]}")


def files_without_rows(files: DataFrame, history: DataFrame) -> DataFrame:
    """Listed files that left no row in the history."""
    landed = history.select("source_object_path").distinct()
    return files.join(landed, "source_object_path", "left_anti")


def batch_counts(rows: DataFrame) -> DataFrame:
    """Rows per batch."""
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("row_count"))


def load_validation(expected: DataFrame, history: DataFrame) -> DataFrame:
    """Expected against loaded rows per batch; a batch missing on one side counts 0 there."""
    wanted = batch_counts(expected).withColumnRenamed("row_count", "expected_rows")
    found = batch_counts(history).withColumnRenamed("row_count", "actual_rows")
    sides = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("expected_rows", "actual_rows")}
    joined = wanted.join(found, "batch_id", "full_outer").withColumns(sides)
    return joined.withColumn("matches", (F.col("expected_rows") == F.col("actual_rows")).cast("int"))


def content_digests(rows: DataFrame, key: str = "batch_id") -> DataFrame:
    """Rows per key and the sum of their content numbers.

    The sum does not depend on the order of rows or on how they lie in files, repeated rows
    count as often as they occur, and map tasks send one partial row per key.
    """
    number = content_number(["booking_key", *SOURCE_COLUMNS])
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(number).cast("string").alias("content_digest")
    )


def content_validation(expected: DataFrame, history: DataFrame, key: str = "batch_id") -> DataFrame:
    """Expected against loaded content per batch, or per ``source_object_path``.

    Finds what equal counts hide: a changed, swapped or doubled row. A key missing on one side
    has 0 rows and an empty digest there.
    """
    sides = []
    for side, rows in (("expected", expected), ("actual", history)):
        found = content_digests(rows, key).withColumnRenamed("row_count", f"{side}_rows")
        sides.append(found.withColumnRenamed("content_digest", f"{side}_digest"))
    # both sides in one aggregate: a NULL key meets a NULL key
    wanted, found = sides
    both = wanted.unionByName(found, allowMissingColumns=True).groupBy(key)
    names = [f"{side}_{what}" for what in ("rows", "digest") for side in ("expected", "actual")]
    joined = both.agg(
        *[F.coalesce(F.max(n), F.lit(0) if n.endswith("_rows") else F.lit("")).alias(n) for n in names]
    )
    same = (F.col("expected_rows") == F.col("actual_rows")) & (F.col("expected_digest") == F.col("actual_digest"))
    return joined.withColumn("matches", same.cast("int"))


def missing_batches(expected: DataFrame, history: DataFrame) -> DataFrame:
    """Batch ids that were expected and are not in the history."""
    return expected.select("batch_id").subtract(history.select("batch_id"))

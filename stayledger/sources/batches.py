"""Change-batch files: discovery, reading, lineage and the raw landing layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions.cleaning import at_least, parse_effective_at
from stayledger.functions.hashing import row_ingestion_id
from stayledger.schema import BATCH_COLUMNS, BATCH_FILE_SCHEMA, HISTORY_COLUMNS, SOURCE_COLUMNS
from stayledger.session import broadcast_if_small

# File pattern, directory levels and number formats of the layout.
BATCH_GLOB = "batch_*.csv"
ANY_CSV = "*.{csv,csv.gz}"
LANDING_LEVELS = ["etl_year", "etl_month", "etl_day", "raw_batch_sequence", "batch_file"]
LANDED_FILE = r"/batch_file=([^/]+?)(?:\.csv)?/"
LAST_NAME = r"([^/]+?)(?:\.csv)?(?:\.gz)?$"

#: Rows of a landed file at most, some 30 MB of text: a file is hashed as one value and read by one task.
FILE_ROWS = 100_000


def _batch_of(path: Column) -> Column:
    """Batch id by location: the landing directory, else the file's stem."""
    landed = F.regexp_extract(path, LANDED_FILE, 1)
    return F.when(landed != "", landed).otherwise(F.regexp_extract(path, LAST_NAME, 1))


def batch_files(spark: SparkSession, at: str | list[str], pattern: str = ANY_CSV) -> DataFrame:
    """One row per file: path, name, bytes and batch id. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(at)
        .select(
            "path",
            F.col("_metadata.file_path").alias("source_object_path"),
            F.col("_metadata.file_name").alias("source_file_name"),
            F.col("length").alias("file_bytes"),
            _batch_of(F.col("path")).alias("batch_id"),
        )
    )


def list_batch_files(spark: SparkSession, root: str, pattern: str = BATCH_GLOB) -> DataFrame:
    """The batch files under a folder; it is an error if there are none."""
    files = batch_files(spark, root, pattern)
    if files.isEmpty():
        raise FileNotFoundError(f"no {pattern} under {root}")
    return files


def read_batch_files(spark: SparkSession, paths: str | list[str], pattern: str = ANY_CSV) -> DataFrame:
    """All files in one scan, every column as text.

    The header of each file is compared with the schema, because columns are
    mapped by position.
    """
    return (
        spark.read.schema(BATCH_FILE_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .csv(paths)
    )


def read_batches(spark: SparkSession, root: str, pattern: str = BATCH_GLOB) -> DataFrame:
    list_batch_files(spark, root, pattern)
    return read_batch_files(spark, root, pattern)


def file_hashes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SHA-256 of each file's bytes, one file per row and in parallel over files.

    A hash of a file is sequential by nature, so a file must fit Spark's limit
    for one binary value (2 GB); larger batches are landed as several files.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", ANY_CSV)
        .load(paths)
        .select(
            F.col("_metadata.file_path").alias("source_object_path"),
            F.sha2(F.col("content"), 256).alias("file_hash"),
        )
    )


def _load_time(sequence: Column, effective: Column) -> dict[str, Column]:
    return {
        "etl_year": F.year(effective),
        "etl_month": F.month(effective),
        "etl_day": F.dayofmonth(effective),
        "etl_date": F.date_format(effective, "yyyyMMdd"),
        "raw_batch_sequence": at_least(sequence.cast("string"), 3),
    }


def _or_fail(value: Column, message: str, raw: str) -> Column:
    text = F.concat(F.lit(message), F.coalesce(F.col(raw), F.lit("(empty)")))
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(text))


def typed_batch_columns() -> dict[str, Column]:
    """Batch columns as typed values; an unreadable sequence or time stops the load."""
    return {
        "original_source_row_number": F.col("original_source_row_number").try_cast("bigint"),
        "batch_sequence": _or_fail(
            F.trim("batch_sequence").try_cast("int"), "invalid batch_sequence: ", "batch_sequence"
        ),
        "batch_effective_at": _or_fail(
            parse_effective_at(F.col("batch_effective_at")),
            "unsupported batch_effective_at: ",
            "batch_effective_at",
        ),
        "batch_row_number": F.col("batch_row_number").try_cast("bigint"),
    }


def with_lineage(rows: DataFrame) -> DataFrame:
    """Typed batch columns, load date, file name and path, row identity.

    Everything comes from the row and its file's metadata, in the same scan.
    """
    located = rows.select(
        "*",
        F.col("_metadata.file_path").alias("source_object_path"),
        F.col("_metadata.file_name").alias("source_file_name"),
    )
    batch = F.coalesce(F.nullif(F.trim("batch_id"), F.lit("")), _batch_of(F.col("source_object_path")))
    typed = located.withColumns({**typed_batch_columns(), "batch_id": batch})
    dated = typed.withColumns(_load_time(F.col("batch_sequence"), F.col("batch_effective_at")))
    return dated.withColumns({"ingested_at": F.current_timestamp(), "row_ingestion_id": row_ingestion_id()})


def history_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The given batch files as rows of the history table, in its column order."""
    hashes = broadcast_if_small(file_hashes(spark, paths), rows=len(paths))
    rows = with_lineage(read_batch_files(spark, paths))
    return rows.join(hashes, "source_object_path", "left").select(*HISTORY_COLUMNS)


def batch_file_summary(rows: DataFrame) -> DataFrame:
    """Per file: rows and the batch values of its first row.

    ``rows`` is a scan of batch files. The first row is the one with the lowest
    position in the file's first block.
    """
    position = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    placed = rows.select(
        F.col("_metadata.file_path").alias("source_object_path"), position.alias("position"), *BATCH_COLUMNS
    )
    first = F.min_by(F.struct("batch_id", "batch_sequence", "batch_effective_at"), "position")
    summary = placed.groupBy("source_object_path").agg(F.count(F.lit(1)).alias("row_count"), first.alias("first"))
    effective = parse_effective_at(F.col("first.batch_effective_at"))
    sequence = F.trim("first.batch_sequence").try_cast("int")
    located = _batch_of(F.col("source_object_path"))
    return summary.select(
        "source_object_path",
        F.coalesce(F.nullif(F.trim("first.batch_id"), F.lit("")), located).alias("batch_id"),
        sequence.alias("batch_sequence"),
        effective.alias("batch_effective_at"),
        *[value.alias(name) for name, value in _load_time(sequence, effective).items()],
        "row_count",
    )


def land_batches(rows: DataFrame, root: str, further: bool = False, file_rows: int = FILE_ROWS) -> None:
    """Write batch rows to the raw landing layout.

    ``etl_year=/etl_month=/etl_day=/raw_batch_sequence=/batch_file=<batch>.csv/``:
    the last level is a directory, so a large batch is written by many tasks, in files of
    ``file_rows`` at most. Text repeats itself, so the files are gzipped; Spark reads them by their ending.
    Landing a batch again replaces that batch only, unless the rows are
    ``further`` files of it.
    """
    text = {c: F.col(c).cast("string") for c in BATCH_COLUMNS}
    text["batch_effective_at"] = F.coalesce(
        F.date_format(F.col("batch_effective_at").try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss"),
        text["batch_effective_at"],
    )
    texts = rows.select(*[text[c].alias(c) for c in BATCH_COLUMNS], *SOURCE_COLUMNS)
    effective = parse_effective_at(F.col("batch_effective_at"))
    levels = {
        "etl_year": F.date_format(effective, "yyyy"),
        "etl_month": F.date_format(effective, "MM"),
        "etl_day": F.date_format(effective, "dd"),
        "raw_batch_sequence": at_least(F.col("batch_sequence"), 3),
        "batch_file": F.concat(F.col("batch_id"), F.lit(".csv")),
    }
    (
        texts.withColumns(levels)
        .write.partitionBy(*LANDING_LEVELS)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", file_rows)
        .option("header", True)
        .option("escape", '"')
        .option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("append" if further else "overwrite")
        .csv(root)
    )

"""From raw history to one current, cleaned and typed row per booking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.functions import cleaning
from stayledger.functions.hashing import record_hash
from stayledger.schema import (
    DEFAULTED_DIMENSIONS,
    HISTORY_TECHNICAL,
    INT_COLUMNS,
    PRICE_TYPE,
    SOURCE_COLUMNS,
    UNKNOWN,
)

DEDUP_KEYS = ["booking_key", "batch_id", "record_hash"]
DEDUP_ORDER = ["row_ingestion_id", "ingested_at", "batch_row_number"]
#: Columns that hold SHA-256 digests in hex, and what one looks like.
DIGESTS = ["record_hash", "row_ingestion_id", "file_hash"]
DIGEST = r"\A[0-9a-f]{64}\z"


def stage(history: DataFrame, carried: Sequence[str] = SOURCE_COLUMNS) -> DataFrame:
    """Typed technical columns, load-date fallbacks and the record hash.

    The hash is taken over the raw text, before any cleaning. ``carried`` are the columns that
    go on beside them: the source texts, or narrower ones that they can be made from again.
    """
    effective = F.col("batch_effective_at").try_cast("timestamp")
    fallback = {
        "etl_year": F.year(effective),
        "etl_month": F.month(effective),
        "etl_day": F.dayofmonth(effective),
        "etl_date": F.date_format(effective, "yyyyMMdd"),
        "raw_batch_sequence": cleaning.at_least(F.col("batch_sequence").cast("string"), 3),
    }
    technical = {}
    for name, kind in HISTORY_TECHNICAL.items():
        value = F.col(name).try_cast(kind)
        technical[name] = F.coalesce(value, fallback[name]) if name in fallback else value
    return history.select(
        *[value.alias(name) for name, value in technical.items()],
        record_hash(SOURCE_COLUMNS).alias("record_hash"),
        *carried,
    )


def dealt_by_booking(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt by booking once, so that windows by booking need no further shuffle.

    Digests travel as bytes, which are half as long as their digits; any other text in their place travels as it is."""
    names = [c for c in DIGESTS if c in rows.columns]
    short = {c: F.when(F.col(c).rlike(DIGEST), F.unhex(c)) for c in names}
    packed = rows.select(
        *[F.when(short[c].isNull(), F.col(c)).alias(c) if c in short else c for c in rows.columns],
        *[value.alias(f"_{c}") for c, value in short.items()],
    )
    dealt = packed.repartition(*[partitions] * bool(partitions), "booking_key")
    spelled = {c: F.coalesce(F.lower(F.hex(f"_{c}")), F.col(c)).alias(c) for c in names}
    return dealt.select(*[spelled.get(c, c) for c in rows.columns])


def _first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group.

    Filtering ``row_number`` on 1 lets Spark keep one row per key in every map
    task before the shuffle, so a group that holds much of the input arrives as
    one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def dedupe_exact(staged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row per booking, batch and business state: the earliest load of it.

    The batch is part of the key, so a replay in a later batch is kept. ``within`` are further
    columns that a booking has one value of; rows that lie by them already need no shuffle.
    """
    return _first_per(staged, [*within, *DEDUP_KEYS], [F.asc(c) for c in DEDUP_ORDER])


def dedupe_grouped(staged: DataFrame) -> DataFrame:
    """``dedupe_exact`` as one aggregate, for results that use few of its columns: Spark moves these and the keys only.

    With many columns the windows are better, since the aggregate sorts the rows as one value."""
    others = [c for c in staged.columns if c not in DEDUP_KEYS]
    hashed = F.when(F.col("record_hash").rlike(DIGEST), F.unhex("record_hash"))
    keys = [F.col("booking_key"), F.col("batch_id"), hashed.alias("_hash"), F.when(hashed.isNull(), F.col("record_hash")).alias("_text")]
    first = F.min_by(F.struct(*others), F.struct(*DEDUP_ORDER)).alias("_first")
    spelled = {c: F.col("_first")[c].alias(c) for c in others}
    spelled["record_hash"] = F.coalesce(F.lower(F.hex("_hash")), F.col("_text")).alias("record_hash")
    return staged.groupBy(*keys).agg(first).select(*[spelled.get(c, c) for c in staged.columns])


def latest_per_key(deduped: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The latest record of each booking; the hash makes the order total. ``within`` as above."""
    latest = ["batch_sequence", "batch_effective_at", "batch_row_number", "row_ingestion_id", "record_hash"]
    return _first_per(deduped, [*within, "booking_key"], [F.desc(c) for c in latest])


def clean_and_type(latest: DataFrame) -> DataFrame:
    """Null-like text to NULL, numbers and dates parsed, dimensions defaulted.

    Trimming is a projection of its own, as later ones use each trimmed text
    more than once. It also keeps every generated method small enough for the
    JVM to compile.
    """
    trimmed = latest.withColumns({c: F.trim(c) for c in SOURCE_COLUMNS})
    values = {c: cleaning.null_if_absent(F.col(c)) for c in SOURCE_COLUMNS}
    values |= {c: values[c].try_cast("int") for c in INT_COLUMNS}
    values |= {c: F.coalesce(values[c], F.lit(UNKNOWN)) for c in DEFAULTED_DIMENSIONS}
    values["adr"] = values["adr"].try_cast(PRICE_TYPE)
    values["reservation_status_date"] = values["reservation_status_date"].try_cast("date")
    typed = trimmed.withColumnsRenamed(
        {"batch_id": "current_batch_id", "batch_sequence": "current_batch_sequence"}
    ).withColumns(values)
    numbered = typed.withColumn("arrival_month_number", cleaning.month_number(F.col("arrival_date_month")))
    return numbered.withColumn(
        "arrival_date",
        cleaning.date_from_parts(
            F.col("arrival_date_year"), F.col("arrival_month_number"), F.col("arrival_date_day_of_month")
        ),
    )


def current_state(deduped: DataFrame) -> DataFrame:
    return clean_and_type(latest_per_key(deduped))

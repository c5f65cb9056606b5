"""Named queries over a folder of star tables, one per operator.

Each takes ``(spark, folder)`` and returns a DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.functions.buckets import guest_type, lead_time_bucket, stay_length_bucket
from stayledger.operators import quality
from stayledger.operators.change_batches import KEY_COLUMNS, compose_batches, expected_current, with_keys
from stayledger.operators.charts import CHARTS, apply_filters, chart_query, stay_length_distribution
from stayledger.operators.history import clean_and_type, current_state, dedupe_exact, dedupe_grouped, latest_per_key, stage
from stayledger.operators.marts import DIMENSIONS, MARTS, build_dimension, build_mart
from stayledger.operators.metrics import booking_metrics, fact_bookings
from stayledger.operators.profile import column_profile, price_spread, revenue_profile
from stayledger.operators.saved import SAVED, reconcile, refresh
from stayledger.plans import refresh as refreshing
from stayledger.plans.refresh import open_refreshed
from stayledger.plans.star import star_current, star_lines_by_order, star_rows_by_booking, star_staged_current
from stayledger.plans.warehouse import (
    build_from_rows,
    dealt_current,
    rows_by_booking,
    serving_relations,
)
from stayledger.schema import SOURCE_COLUMNS
from stayledger.session import COMPILED_METHOD_LIMIT, TEXT_CODEC, apply_conf, materialize, new_path, scratch
from stayledger.sources.batches import (
    ANY_CSV,
    batch_file_summary,
    file_hashes,
    land_batches,
    list_batch_files,
    read_batch_files,
)
from stayledger.sources.history import (
    batch_counts,
    content_validation,
    files_without_rows,
    ingest,
    load_validation,
    missing_batches,
    read_history,
)
from stayledger.sources.star import (
    DATASET,
    by_booking,
    delivered_lines,
    history_of_lines,
    source_texts,
    star_bookings,
    star_history,
    star_lines,
)
from stayledger.sources.versions import Versions

Query = Callable[[SparkSession, str], DataFrame]

#: Marts with a query over merged deliveries; the tests hold all of them against a rebuild.
INCREMENTAL_MARTS = ["mart_daily_booking_revenue", "mart_hotel_performance", "mart_cancellation_analysis", "mart_simulated_pnl"]

SOURCE_ORDER = ["l_orderkey", "l_linenumber", "l_returnflag", "ship_day", "l_partkey", "l_suppkey"]

#: Dashboard selection used by the filtered chart queries.
SELECTION = {
    "month_range": (date(1996, 1, 1), date(1998, 12, 1)),
    "market_segment": ["BUILDING", "MACHINERY"],
    "hotel": ["F"],
}

#: Queries with one dashboard filter each: chart and selection.
ONE_FILTER = {
    "chart_filtered_days": ("chart_daily_bookings", {"date_range": (date(1997, 3, 1), date(1999, 6, 30))}),
    "chart_filtered_channels": (
        "chart_cancellation_breakdown",
        {"distribution_channel": ["1-URGENT", "3-MEDIUM"]},
    ),
    "chart_filtered_countries": (
        "chart_countries_by_revenue",
        {"country": ["NATION_1", "NATION_4", "Unknown"]},
    ),
    "chart_filtered_rooms": ("chart_cancellation_by_room", {"room_type": ["PROMO", "SMALL"]}),
    "chart_filtered_customer_types": ("chart_customer_types", {"customer_type": ["F", "O"]}),
}


def portable(df: DataFrame) -> DataFrame:
    """Results in types every SQL engine prints alike: decimals as DOUBLE, dates
    and times as ISO text. The operators themselves keep exact types."""

    def plain(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return value.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# --- history -----------------------------------------------------------------


def _stored_history(spark: SparkSession, folder: str) -> DataFrame:
    """The star history for several uses: the joined lines are written, as they are far narrower."""
    return history_of_lines(delivered_lines(materialize(star_lines(spark, folder), "lines", TEXT_CODEC)))


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    return stage(star_history(spark, folder))


def stage_record_hash(spark: SparkSession, folder: str) -> DataFrame:
    load = ["etl_year", "etl_month", "etl_day", "etl_date", "raw_batch_sequence", "batch_effective_at"]
    keys = ["booking_key", "batch_id", "batch_row_number", "row_ingestion_id"]
    return _staged(spark, folder).select(*keys, *load, "record_hash")


def deduped(spark: SparkSession, folder: str) -> DataFrame:
    kept = ["booking_key", "batch_id", "record_hash", "row_ingestion_id", "batch_row_number"]
    return dedupe_exact(_staged(spark, folder)).select(*kept)


def current(spark: SparkSession, folder: str) -> DataFrame:
    kept = ["booking_key", "batch_id", "batch_sequence", "batch_row_number", "record_hash"]
    return star_staged_current(spark, folder).select(*kept)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    extra = ["arrival_month_number", "arrival_date"]
    return star_current(spark, folder).select("booking_key", *SOURCE_COLUMNS, *extra)


def cleaned_history(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaning and typing of every delivered row, not only the current ones."""
    typed = clean_and_type(_staged(spark, folder))
    return typed.groupBy("current_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("children").alias("with_children"),
        F.count_if(F.col("country") == "Unknown").alias("unknown_country"),
        F.count("arrival_date").alias("valid_arrival_dates"),
        F.sum("adr").alias("total_adr"),
        F.sum("arrival_month_number").alias("total_month_numbers"),
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return booking_metrics(star_current(spark, folder))


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return fact_bookings(metrics(spark, folder))


def _bucket_counts(name: str, bucket) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = metrics(spark, folder).withColumn("bucket", bucket())
        return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("bookings")).withColumnRenamed("bucket", name)

    return run


# --- marts and charts ---------------------------------------------------------


def _dimension(name: str) -> Query:
    return lambda spark, folder: build_dimension(metrics(spark, folder), name)


def _mart(name: str) -> Query:
    return lambda spark, folder: build_mart(fact(spark, folder), name)


def _chart(name: str) -> Query:
    chart = CHARTS[name]
    return lambda spark, folder: chart_query(_mart(chart.mart)(spark, folder), chart)


def _filtered_chart(name: str, selection: dict = SELECTION) -> Query:
    chart = CHARTS[name]
    return lambda spark, folder: chart_query(
        apply_filters(_mart(chart.mart)(spark, folder), selection), chart
    )


# --- saved aggregates -----------------------------------------------------------


def _saved(name: str) -> Query:
    return lambda spark, folder: refresh(fact(spark, folder), name)


def reconcile_saved(spark: SparkSession, folder: str) -> DataFrame:
    """Saved against recomputed, and against marts that miss the newest batch."""
    rows = star_rows_by_booking(spark, folder)
    relations = build_from_rows(rows)
    older_rows = rows.where(F.col("batch_sequence") < 3)  # still by booking, so nothing wide is shuffled again
    older = serving_relations(booking_metrics(current_state(dedupe_exact(older_rows))))
    parts = []
    for name, spec in SAVED.items():
        fresh = reconcile(relations[name], relations[spec.mart], name)
        stale = reconcile(relations[name], older[spec.mart], name)
        parts += [
            fresh.withColumn("compared_with", F.lit("fresh")),
            stale.withColumn("compared_with", F.lit("stale")),
        ]
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


# --- checks ---------------------------------------------------------------------


def _built(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return build_from_rows(star_rows_by_booking(spark, folder))


def known_current(spark: SparkSession, folder: str) -> dict[str, str]:
    """Two bookings whose current batch follows from their order lines, by booking key.

    One came back in the last batch after the first, one was replayed in the second; the
    first of each kind, so two rows reach the driver."""
    delivered = spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_returnflag").alias("first"), F.max("l_returnflag").alias("last")
    )
    found = {}
    for first, last, batch in (("A", "R", "batch_003"), ("A", "N", "batch_002")):
        of_kind = delivered.where((F.col("first") == first) & (F.col("last") == last))
        for row in of_kind.orderBy("l_orderkey", "l_linenumber").limit(1).collect():
            found[f"{DATASET}:{row['l_orderkey']}:{row['l_linenumber']}"] = batch
    return found


def check_suite(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_suite(_built(spark, folder), known_current(spark, folder))


def run_validation(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_validation(_built(spark, folder))


def object_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.object_counts(_built(spark, folder))


def multi_state_batches(spark: SparkSession, folder: str) -> DataFrame:
    return quality.multi_state_batches(_staged(spark, folder))


def current_vs_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_totals(_staged(spark, folder), star_current(spark, folder))


# --- from what is new ---------------------------------------------------------------


def _deliveries(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The star history in three deliveries: earlier batches, late rows of them with a part of the last, the rest.

    The last one also repeats the rows of a tenth of the bookings. Each is dealt by booking while its
    rows are narrow."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    delivered = delivered_lines(materialize(star_lines(spark, folder), "lines", TEXT_CODEC))
    rows = history_of_lines(by_booking(delivered, buckets))
    part = F.pmod(F.xxhash64("booking_key", "batch_row_number"), F.lit(10))
    last = F.col("batch_sequence") == 3
    first = rows.where(~last & (part < 6))
    second = rows.where((~last & (part >= 6) & (part < 9)) | (last & (part < 5)))
    third = rows.where((~last & (part == 9)) | (last & (part >= 5)) | (part == 0))
    return [first, second, third]


#: Deliveries lie by booking, so they are merged as they stand.
merge_rows = partial(refreshing.merge_rows, dealt=True)


def _merged(spark: SparkSession, folder: str, *marts: str) -> dict[str, DataFrame]:
    """State and some marts after three deliveries, merged one after the other."""
    store = Versions(spark, new_path(spark, "refreshed"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # fewer would not grow with the tables
    with scratch(spark):
        for rows in _deliveries(spark, folder):
            version, tables = store.current()
            with scratch(spark):  # what a merge stores on its way goes with it
                store.commit(merge_rows(store, tables, rows, buckets, marts), on=version)
            store.expire(timedelta(0))  # nothing reads the state before
    return open_refreshed(spark, store.root)


def current_incremental(spark: SparkSession, folder: str) -> DataFrame:
    kept = ["booking_key", "batch_id", "batch_sequence", "batch_row_number", "record_hash"]
    return latest_per_key(_merged(spark, folder)["state"]).select(*kept)


def _mart_incremental(name: str) -> Query:
    return lambda spark, folder: _merged(spark, folder, name)[name]


def _metric_check(check) -> Query:
    return lambda spark, folder: check(metrics(spark, folder))


def invalid_dates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.invalid_arrival_dates(star_current(spark, folder))


def negative_source_prices(spark: SparkSession, folder: str) -> DataFrame:
    return quality.non_negative(metrics(spark, folder), "source_adr").select("booking_key", "source_adr")


# --- batches and ingest -----------------------------------------------------------


def counts_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return batch_counts(star_history(spark, folder)).orderBy("batch_id")


def change_batches(spark: SparkSession, folder: str) -> DataFrame:
    # Numbering reads its input twice, to order it and to rank: join once, before.
    # Lines are numbered before they are spelled out and where the join left them: only the orders' sizes move.
    path = new_path(spark, "change_batches")
    with scratch(spark):
        lines = star_lines_by_order(spark, folder)
        numbered = with_keys(lines, DATASET, SOURCE_ORDER, SOURCE_ORDER[0])
        numbered = materialize(numbered, "numbered", TEXT_CODEC, path)
    return compose_batches(source_texts(numbered, [*SOURCE_ORDER, *KEY_COLUMNS]), DATASET)


def _landed(spark: SparkSession, folder: str) -> str:
    root = new_path(spark, "landing")
    with scratch(spark):
        land_batches(change_batches(spark, folder), root)
    return root


def _loaded(spark: SparkSession, folder: str) -> tuple[str, str]:
    root, history = _landed(spark, folder), new_path(spark, "history")
    ingest(spark, root, history, pattern=ANY_CSV)
    return root, history


def _loaded_history(spark: SparkSession, folder: str) -> DataFrame:
    """The history after landing and load; the landed files are not kept."""
    history = new_path(spark, "history")
    with scratch(spark):
        ingest(spark, _landed(spark, folder), history, pattern=ANY_CSV)
    return read_history(spark, history)


def _loaded_twice(spark: SparkSession, folder: str, force: bool = False) -> DataFrame:
    """The same after a second load of the same landing folder."""
    history = new_path(spark, "history")
    with scratch(spark):
        root = _landed(spark, folder)
        for again in (False, force):
            ingest(spark, root, history, force=again, pattern=ANY_CSV)
    return read_history(spark, history)


def ingest_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per batch after loading the same landing folder twice."""
    return batch_counts(_loaded_twice(spark, folder))


def ingest_forced(spark: SparkSession, folder: str) -> DataFrame:
    """A forced second load doubles the history and leaves the deduplicated rows as they were."""
    rows = _loaded_twice(spark, folder, force=True)
    kept = batch_counts(dedupe_grouped(stage(rows))).withColumnRenamed("row_count", "deduped_rows")
    return batch_counts(rows).withColumnRenamed("row_count", "loaded_rows").join(kept, "batch_id")


def ingest_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Load columns per batch: dates from the batch time, one file hash per file."""
    load = ["batch_id", "batch_sequence", "etl_year", "etl_month", "etl_day", "etl_date", "raw_batch_sequence"]
    return _loaded_history(spark, folder).groupBy(*load, F.col("batch_effective_at")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.length("file_hash") == 64).alias("hashed_rows"),
        F.count_if(F.length("row_ingestion_id") == 64).alias("identified_rows"),
    )


def ingested_current(spark: SparkSession, folder: str) -> DataFrame:
    """Current bookings per batch after loading the five change batches."""
    rows = dealt_current(_loaded_history(spark, folder))
    return rows.groupBy("current_batch_id").agg(F.count(F.lit(1)).alias("bookings"))


def ingested_hotel_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The hotel mart over bookings that went through landing, load, dedup and current state."""
    current = dealt_current(_loaded_history(spark, folder))
    return build_mart(fact_bookings(booking_metrics(current)), "mart_hotel_performance")


def ingested_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Run validation with the two bookings whose current batch is known."""
    relations = build_from_rows(rows_by_booking(_loaded_history(spark, folder)))
    return quality.run_validation(relations, expected_current(DATASET))


def _star_batches(spark: SparkSession, folder: str, history: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The star history as deliveries of three batches, one a day: a first part and a late one."""
    day = F.make_date(F.lit(2026), F.lit(1), F.col("batch_sequence")).cast("timestamp")
    history = _stored_history(spark, folder) if history is None else history
    rows = history.withColumn("batch_effective_at", day)
    late = F.pmod("batch_row_number", F.lit(4)) >= 2
    return rows.where(~late), rows.where(late)


def _late_load(spark: SparkSession, folder: str, star: DataFrame | None = None) -> tuple[str, list[int]]:
    """Three loads of one landing folder: at first, again, and after more files of the same batches.

    The landed files are not kept. ``star`` is the star history if it is stored already."""
    history = new_path(spark, "history")
    with scratch(spark):
        first, late = _star_batches(spark, folder, star)
        root = new_path(spark, "landing")
        land_batches(first, root)
        appended = [ingest(spark, root, history, pattern=ANY_CSV) for _ in range(2)]
        land_batches(late, root, further=True)
        return history, [*appended, ingest(spark, root, history, pattern=ANY_CSV)]


def ingest_late_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per batch and load date once late files of loaded batches came in."""
    history, _ = _late_load(spark, folder)
    rows = read_history(spark, history)
    return rows.groupBy("batch_id", "etl_date", "raw_batch_sequence").agg(F.count(F.lit(1)).alias("row_count"))


def ingest_load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The row counts that three loads return."""
    _, appended = _late_load(spark, folder)
    return spark.createDataFrame(list(zip(["first", "again", "late"], appended)), "load string, appended long")


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """First-row values and row counts of the landed files, added up per batch."""
    rows = read_batch_files(spark, _landed(spark, folder))
    keys = ["batch_id", "batch_sequence", "batch_effective_at", "etl_date", "raw_batch_sequence"]
    return batch_file_summary(rows).groupBy(*keys).agg(F.sum("row_count").alias("row_count"))


def landed_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Files listed, hashed and loaded, per batch: all three must agree."""
    root, history = _loaded(spark, folder)
    files = list_batch_files(spark, root, ANY_CSV)
    paths = [row["path"] for row in files.select("path").collect()]
    hashed = files.join(file_hashes(spark, paths), "source_object_path", "left")
    unloaded = files_without_rows(files, read_history(spark, history)).select("source_object_path")
    marked = hashed.join(unloaded.withColumn("unloaded", F.lit(1)), "source_object_path", "left")
    return marked.groupBy("batch_id").agg(
        (F.count(F.lit(1)) == F.count("file_hash")).cast("int").alias("all_hashed"),
        F.count("unloaded").alias("files_without_rows"),
    )


def validated_load(spark: SparkSession, folder: str) -> DataFrame:
    """Expected and loaded rows per batch."""
    root, history = _loaded(spark, folder)
    return load_validation(read_batch_files(spark, root), read_history(spark, history))


def validated_content(spark: SparkSession, folder: str) -> DataFrame:
    """The star history's content per batch against what several loads of its files left."""
    star = _stored_history(spark, folder)
    history, _ = _late_load(spark, folder, star)
    return content_validation(star, read_history(spark, history))


def absent_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of the change set that the star history does not have."""
    return missing_batches(change_batches(spark, folder), star_history(spark, folder))


# --- profile ------------------------------------------------------------------------


def _source(spark: SparkSession, folder: str) -> DataFrame:
    return star_bookings(spark, folder).select(*SOURCE_COLUMNS)


def profile_missing(spark: SparkSession, folder: str) -> DataFrame:
    return column_profile(_source(spark, folder)).select("column_name", "row_count", "missing_count")


def profile_types(spark: SparkSession, folder: str) -> DataFrame:
    return column_profile(_source(spark, folder)).select("column_name", "inferred_type")


def profile_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same profile on a table that is not bookings."""
    return column_profile(spark.read.parquet(f"{folder}/events.parquet"))


def profile_price(spark: SparkSession, folder: str) -> DataFrame:
    return price_spread(_source(spark, folder))


def profile_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return revenue_profile(_source(spark, folder))


def stay_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return stay_length_distribution(fact(spark, folder))


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "stage_record_hash": stage_record_hash,
        "dedupe_exact": deduped,
        "current_state": current,
        "clean_and_type": cleaned,
        "clean_history": cleaned_history,
        "booking_metrics": metrics,
        "lead_time_bucket": _bucket_counts(
            "lead_time_bucket", lambda: lead_time_bucket(F.col("lead_time"))
        ),
        "stay_length_bucket": _bucket_counts(
            "stay_length_bucket", lambda: stay_length_bucket(F.col("total_nights"))
        ),
        "guest_type": _bucket_counts(
            "guest_type", lambda: guest_type(F.col("adults"), F.col("children"), F.col("babies"))
        ),
        "fact_bookings": fact,
        **{name: _dimension(name) for name in DIMENSIONS},
        **{name: _mart(name) for name in MARTS},
        "current_incremental": current_incremental,
        **{f"{name}_incremental": _mart_incremental(name) for name in INCREMENTAL_MARTS},
        **{name: _saved(name) for name in SAVED},
        "reconcile_saved": reconcile_saved,
        "check_suite": check_suite,
        "run_validation": run_validation,
        "object_counts": object_counts,
        "check_multi_state_batches": multi_state_batches,
        "check_current_vs_distinct": current_vs_distinct,
        "check_non_negative": negative_source_prices,
        "warn_adr_outliers": _metric_check(quality.adr_outliers),
        "warn_zero_nights": _metric_check(quality.zero_nights),
        "warn_zero_guests": _metric_check(quality.zero_guests),
        "warn_missing_dims": _metric_check(quality.missing_dimensions),
        "warn_invalid_dates": invalid_dates,
        "batch_counts": counts_per_batch,
        "change_batches": change_batches,
        "absent_batches": absent_batches,
        "ingest_idempotent": ingest_idempotent,
        "ingest_forced": ingest_forced,
        "ingest_late_files": ingest_late_files,
        "ingest_load_counts": ingest_load_counts,
        "ingest_lineage": ingest_lineage,
        "ingest_current": ingested_current,
        "ingest_hotel_mart": ingested_hotel_mart,
        "ingest_checks": ingested_checks,
        "ingest_validation": validated_load,
        "ingest_content_validation": validated_content,
        "landed_files": landed_files,
        "landed_hashes": landed_hashes,
        "profile_missing": profile_missing,
        "profile_types": profile_types,
        "profile_events": profile_events,
        "profile_price_iqr": profile_price,
        "profile_revenue": profile_revenue,
        **{name: _chart(name) for name in CHARTS},
        "chart_stay_lengths": stay_lengths,
        "chart_filtered": _filtered_chart("chart_cancellation_breakdown"),
        "chart_filtered_months": _filtered_chart("chart_monthly_estimated_revenue"),
        **{name: _filtered_chart(*chosen) for name, chosen in ONE_FILTER.items()},
    }
    return {name: _portable_query(query) for name, query in queries.items()}


def _portable_query(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        apply_conf(spark, COMPILED_METHOD_LIMIT)  # else wide projections are interpreted, several times as slow
        return portable(query(spark, folder))

    return run

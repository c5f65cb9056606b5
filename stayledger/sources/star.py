"""A booking history derived from star-schema order tables.

One order line is one delivered booking row. The line's return flag names the
batch, so a line number that occurs more than once in an order becomes several
versions of one booking, some within one batch. Lines of the last batch are
delivered twice, which gives exact duplicates. A few columns are mapped so that
real values exercise the cleaning rules: customers in debt have no country, a
part size ending in 0 leaves the children field empty, a full discount is booked
as a negative price, and the day of month is the order's, which does not exist
in every month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions.cleaning import at_least
from stayledger.functions.hashing import row_ingestion_id
from stayledger.schema import HISTORY_COLUMNS, HISTORY_SCHEMA, SOURCE_COLUMNS

# Fixed values of this mapping.
DATASET = "orders"
FLAG_SEQUENCE = {"A": 1, "N": 2, "R": 3}
MONTHS = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order, customer, nation and part.

    The join strategy is left to Spark: the small tables are broadcast while
    their files are under the session's threshold and shuffled beyond it, and
    AQE splits a hot order or part.
    """
    t = {name: _table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation", "part")}
    customers = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t["orders"].join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return (
        t["lineitem"]
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns(
            {"ship_day": F.col("l_shipdate").cast("date"), "order_day": F.col("o_orderdate").cast("date")}
        )
    )


def _source_values() -> dict[str, Column]:
    ship, order = F.col("ship_day"), F.col("order_day")
    size, line = F.col("p_size"), F.col("l_linenumber")
    returned = F.col("l_returnflag") == "R"
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return {
        "hotel": F.col("l_linestatus"),
        "is_canceled": F.when(returned, "1").otherwise("0"),
        "lead_time": F.datediff(ship, order) % 250,
        "arrival_date_year": F.year(ship),
        "arrival_date_month": F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(ship)),
        "arrival_date_week_number": F.weekofyear(ship),
        "arrival_date_day_of_month": F.dayofmonth(order),
        "stays_in_weekend_nights": line % 3,
        "stays_in_week_nights": F.col("l_quantity").cast("int") % 12,
        "adults": line % 4,
        "children": F.when(size % 10 == 0, "").otherwise((size % 3).cast("string")),
        "babies": F.col("l_partkey") % 2,
        "meal": F.col("p_brand"),
        "country": F.when(F.col("c_acctbal") < 0, "NULL").otherwise(F.concat(F.lit(" "), F.col("n_name"))),
        "market_segment": F.col("c_mktsegment"),
        "distribution_channel": F.col("o_orderpriority"),
        "is_repeated_guest": F.when(F.col("c_acctbal") > 5000, "1").otherwise("0"),
        "previous_cancellations": line - 1,
        "previous_bookings_not_canceled": F.lit("0"),
        "reserved_room_type": F.col("p_type"),
        "assigned_room_type": F.col("p_brand"),
        "booking_changes": line % 2,
        "deposit_type": F.col("l_returnflag"),
        "agent": F.col("l_suppkey"),
        "company": F.lit("NULL"),
        "days_in_waiting_list": F.lit("0"),
        "customer_type": F.col("o_orderstatus"),
        "adr": F.when(F.col("l_discount") >= 0.1, -price).otherwise(price),
        "required_car_parking_spaces": line % 2,
        "total_of_special_requests": size % 4,
        "reservation_status": F.when(returned, "Canceled").otherwise("Check-Out"),
        "reservation_status_date": ship,
    }


#: All that the source texts and the load columns are made from: a line as numbers, dates and codes.
LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_returnflag",
    "l_linestatus",
    "ship_day",
    "order_day",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "p_size",
    "p_brand",
    "p_type",
    "c_acctbal",
    "c_mktsegment",
    "n_name",
    "o_orderpriority",
    "o_orderstatus",
]


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined order lines before they are spelled out as booking rows, which are several times as wide."""
    return _order_lines(spark, sf_dir).select(*LINE_COLUMNS)


def source_texts(lines: DataFrame, keep: list[str]) -> DataFrame:
    """Some columns of the lines and the 32 source columns as text."""
    return lines.select(*keep, *[value.cast("string").alias(name) for name, value in _source_values().items()])


def star_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 32 source columns as text, one row per order line, with the line's keys."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "ship_day"]
    return source_texts(star_lines(spark, sf_dir), keys)


def _booking_key() -> Column:
    return F.concat_ws(":", F.lit(DATASET), F.col("l_orderkey"), F.col("l_linenumber"))


def by_booking(lines: DataFrame, buckets: int) -> DataFrame:
    """Lines, or deliveries of them, with their booking key and dealt by it while they are narrow.

    History rows made of them lie by booking in ``buckets`` partitions, without a shuffle of wide rows."""
    return lines.withColumn("booking_key", _booking_key()).repartition(buckets, "booking_key")


def delivered_lines(lines: DataFrame) -> DataFrame:
    """One row per delivery of a line.

    Duplicates are made by exploding a one- or two-element array, so the tables
    are scanned and joined once.
    """
    deliveries = F.when(F.col("l_returnflag") == "R", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return lines.withColumn("delivery", F.explode(deliveries))


def history_of_lines(delivered: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Delivered lines as rows of the history, behind some columns that are kept of the lines.

    A booking key that the lines have is taken as it is, so that rows dealt by it are known to lie by it."""
    flag = F.col("l_returnflag")
    key = F.col("booking_key") if "booking_key" in delivered.columns else _booking_key()
    sequence = F.coalesce(*[F.when(flag == f, F.lit(n)) for f, n in FLAG_SEQUENCE.items()])
    loaded = source_texts(delivered, delivered.columns).withColumns(
        {
            "source_dataset": F.lit(DATASET),
            "original_source_row_number": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "booking_key": key,
            "batch_sequence": sequence,
            "batch_id": F.concat(F.lit("batch_"), at_least(sequence.cast("string"), 3)),
            "batch_effective_at": F.col("ship_day").cast("timestamp"),
            "batch_row_number": (F.col("l_partkey") * 100000 + F.col("l_suppkey")) * 2 + F.col("delivery"),
            "ingested_at": F.col("ship_day").cast("timestamp"),
            "synthetic_operation": F.when(F.col("delivery") == 0, "initial").otherwise("exact_duplicate"),
        }
    ).withColumn("source_file_name", F.concat(F.col("batch_id"), F.lit(".csv")))
    located = loaded.withColumn("source_object_path", F.concat(F.lit("landing/"), F.col("source_file_name")))
    identified = located.withColumn("row_ingestion_id", row_ingestion_id())
    # etl_* and the file hash stay empty: staging derives the former from the batch time.
    have = set(identified.columns)
    return identified.select(
        *keep,
        *[
            (F.col(c) if c in have else F.lit(None)).cast(HISTORY_SCHEMA[c].dataType).alias(c)
            for c in HISTORY_COLUMNS
        ],
    )


def star_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as an append-only history with batch and lineage columns."""
    return history_of_lines(delivered_lines(star_lines(spark, sf_dir)))

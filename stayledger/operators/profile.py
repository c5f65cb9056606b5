"""Dataset profile: missing values, inferred types, price spread, revenue totals.

Inference looks at all rows, so the answer does not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.cleaning import MISSING_SPELLINGS, is_missing, strip
from stayledger.functions.measures import safe_ratio
from stayledger.operators.ordering import quantiles, value_counts

# What counts as a number or a date, and the outlier rule.
INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"
DECIMAL = (
    r"^[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"
    r"|^[+-]?(inf|infinity)$"
)
DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
TYPE_NAMES = ["integer", "decimal", "date", "string"]
EMPTY_TYPE = "empty"
OUTLIER_FACTOR = 1.5
NUMBER_TYPE = "decimal(28,6)"
PRICE_TYPE = "decimal(28,6)"


def _kind(text: Column) -> Column:
    """Narrowest type of a stripped text: 0 integer, 1 decimal, 2 date, 3 string.

    Patterns decide, not casts: a failing cast costs far more than a pattern
    that does not match. Texts that start like no number need neither.
    """
    lead = F.ascii(text)
    numeric_start = lead.between(ord("+"), ord("9")) | lead.isin(ord("i"), ord("I"))
    is_date = text.rlike(DATE) & text.try_cast("date").isNotNull()
    return (
        F.when(~numeric_start, 3)
        .when(text.rlike(INTEGER), 0)
        .when(F.lower(text).rlike(DECIMAL), 1)
        .when(is_date, 2)
        .otherwise(3)
    )


def _type_name(narrowest: Column, widest: Column) -> Column:
    """Numbers widen to decimal; a column of dates only is a date; any mix is text."""
    integer, decimal, date, text = [F.lit(name) for name in TYPE_NAMES]
    return (
        F.when(widest.isNull(), F.lit(EMPTY_TYPE))
        .when(widest == 0, integer)
        .when(widest == 1, decimal)
        .when((widest == 2) & (narrowest == 2), date)
        .otherwise(text)
    )


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: rows, missing values and inferred type. One pass over the data.

    Values are turned into (column, text) pairs and aggregated by column. Map
    tasks send one partial row per column, and the plan stays as small as for a
    single column however wide the table is.
    """
    columns = columns or df.columns
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = texts.unpivot([], columns, "column_name", "value").withColumn("text", strip(F.col("value")))
    missing = F.coalesce(F.lower("text").isin(MISSING_SPELLINGS), F.lit(True))
    kinds = pairs.select("column_name", F.when(~missing, _kind(F.col("text"))).alias("kind"))
    profiled = kinds.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("kind").isNull()).alias("missing_count"),
        _type_name(F.min("kind"), F.max("kind")).alias("inferred_type"),
    )
    return profiled


def _number(column: str, kind: str = NUMBER_TYPE) -> Column:
    value = F.col(column).cast("string")
    return F.when(~is_missing(value), strip(value).try_cast(kind))


def price_spread(df: DataFrame, column: str = "adr") -> DataFrame:
    """Minimum, maximum, mean, quartiles, outlier bounds and outlier count, one row.

    The data is read once, into value frequencies; the rest works on those.
    """
    counts = value_counts(df.select(_number(column, PRICE_TYPE).alias("price")), "price")
    quartiles = quantiles(counts, "price", {"q1": 0.25, "q3": 0.75}).first()
    q1, q3 = [F.lit(q).cast("double") for q in quartiles]
    spread = (q3 - q1) * OUTLIER_FACTOR
    lower, upper = q1 - spread, q3 + spread
    price, n = F.col("price"), F.col("_n")
    outside = (price.cast("double") < lower) | (price.cast("double") > upper)
    return counts.agg(
        q1.alias("q1"),
        q3.alias("q3"),
        lower.alias("lower_bound"),
        upper.alias("upper_bound"),
        F.min(price).cast("double").alias("min_price"),
        F.max(price).cast("double").alias("max_price"),
        safe_ratio(F.sum(price * n), F.sum(n)).alias("mean_price"),
        F.coalesce(F.sum(F.when(outside, n)), F.lit(0)).alias("outlier_count"),
    )


def revenue_profile(df: DataFrame) -> DataFrame:
    """Zero-night and zero-guest bookings, unusable rows and revenue totals, one row.

    Works on the raw values: a negative price is not floored, and a row without
    one of the needed numbers, or whose revenue has too many digits to be exact,
    is only counted as unusable.
    """
    needed = ["stays_in_weekend_nights", "stays_in_week_nights", "adults", "babies", "adr", "is_canceled"]
    numbers = df.select(
        *[_number(c).alias(c) for c in needed],
        F.coalesce(_number("children"), F.lit(0)).cast(NUMBER_TYPE).alias("children"),
    )
    usable = F.lit(True)
    for c in needed:
        usable = usable & F.col(c).isNotNull()
    nights = F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
    guests = F.col("adults") + F.col("children") + F.col("babies")
    revenue = F.try_multiply(F.col("adr"), nights)
    usable = usable & revenue.isNotNull()
    kept = F.abs("is_canceled") < 1
    return numbers.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~usable).alias("invalid_rows"),
        F.count_if(usable & (nights == 0)).alias("zero_night_rows"),
        F.count_if(usable & (guests == 0)).alias("zero_guest_rows"),
        F.coalesce(F.try_sum(F.when(usable, revenue)), F.lit(0)).alias("estimated_revenue"),
        F.coalesce(F.try_sum(F.when(usable & kept, revenue)), F.lit(0)).alias("realized_revenue"),
    )

"""Current bookings and marts from what is new, without the history.

State: for each booking the deduplicated rows of its latest batch, that is one row but for batches
that hold several states. Earlier batches can never become current again, and within the latest batch the
rows kept are all that a later delivery of the same batch may compete with. So

    state(old rows + new rows) = latest batch of dedupe(state(old rows) + dedupe(new rows))

holds exactly, for late batches and late files of loaded batches, too.

Marts: sums and counts per group. A refresh adds the new version of each changed booking and
subtracts the version that it replaces; groups that no changed booking touches get no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.functions.measures import Parts
from stayledger.operators.history import current_state, dedupe_exact, stage
from stayledger.operators.marts import MARTS, MEASURES, grouped_fact, summed_columns
from stayledger.operators.metrics import booking_metrics, fact_bookings

KEY = "booking_key"
BATCH_ORDER = ["batch_sequence", "batch_effective_at"]


def latest_batch(deduped: DataFrame) -> DataFrame:
    """All rows of each booking's latest batch.

    The rank is filtered, so that map tasks send on only what may be latest."""
    order = Window.partitionBy(KEY).orderBy(*[F.desc(c) for c in BATCH_ORDER])
    return deduped.withColumn("_rank", F.rank().over(order)).where("_rank = 1").drop("_rank")


def _by_booking(rows: DataFrame, buckets: int | None) -> DataFrame:
    """Wide rows dealt by booking once, so that neither window nor a bucketed write shuffles them again."""
    return rows.repartition(buckets, KEY) if buckets else rows


def state_of(history: DataFrame, buckets: int | None = None) -> DataFrame:
    """The state after loading these rows of the history; with ``buckets`` it lies by booking in as many."""
    return latest_batch(dedupe_exact(_by_booking(stage(history), buckets)))


def split_state(state: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of bookings that ``fresh`` does not touch, rows of those that it does).

    With a state bucketed by booking only the keys of ``fresh`` are shuffled. Rows
    without a key count as touched: they are one group in the history as well."""
    keys = fresh.select(KEY).where(F.col(KEY).isNotNull()).distinct()
    known = state.where(F.col(KEY).isNotNull())
    touched = known.join(keys, KEY, "left_semi").unionByName(state.where(F.col(KEY).isNull()))
    return known.join(keys, KEY, "left_anti").select(*state.columns), touched.select(*state.columns)


def merged_state(touched: DataFrame, fresh: DataFrame, buckets: int | None = None) -> DataFrame:
    """The new state of the touched bookings; ``buckets`` as above."""
    return latest_batch(dedupe_exact(_by_booking(touched.unionByName(fresh), buckets)))


def merge_state(state: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The state after further rows of the history."""
    fresh = state_of(new_rows)
    untouched, touched = split_state(state, fresh)
    return untouched.unionByName(merged_state(touched, fresh))


def fact_of_state(state: DataFrame) -> DataFrame:
    """The fact rows of a state's current bookings."""
    return fact_bookings(booking_metrics(current_state(state)))


# --- marts by parts ----------------------------------------------------------------------


def mart_parts(fact: DataFrame, name: str, sign: int = 1) -> DataFrame:
    """Per group the number of rows, and the count and sum of each column that the mart adds up."""
    sums = [(F.count(F.lit(1)) * sign).alias("n_rows")]
    for column in summed_columns(name):
        sums.append((F.count(column) * sign).alias(f"n_{column}"))
        sums.append((F.coalesce(F.sum(column), F.lit(0)) * sign).alias(f"sum_{column}"))
    return grouped_fact(fact, MARTS[name]).agg(*sums)


def _added_up(parts: DataFrame, name: str) -> DataFrame:
    amounts = [c for c in parts.columns if c not in MARTS[name].keys]
    total = parts.groupBy(*MARTS[name].keys).agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in amounts])
    changed = F.lit(False)
    for c in amounts:
        changed = changed | (F.col(c) != 0)
    return total.where(changed)


def changed_parts(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """What a mart's parts change by when bookings of the first fact become those of the second.

    Groups whose amounts stay the same have no row."""
    return _added_up(mart_parts(after, name).unionByName(mart_parts(before, name, -1)), name)


def compacted_parts(parts: DataFrame, name: str) -> DataFrame:
    """One row per group that has bookings."""
    return _added_up(parts, name)


def mart_of_parts(parts: DataFrame, name: str) -> DataFrame:
    """The mart from any number of signed parts; equal to the mart of the whole fact."""
    mart = MARTS[name]
    measures = [MEASURES[m](Parts).alias(m) for m in mart.measures]
    found = parts.groupBy(*mart.keys).agg(F.sum("n_rows").alias("_rows"), *measures)
    return found.where("_rows > 0").drop("_rows")

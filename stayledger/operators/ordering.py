"""Order-dependent operators that stay distributed: numbering and exact quantiles.

Both cut the data into ordered slices with a range shuffle and write it once.
Only per-slice totals (one row per shuffle partition) are ever brought
together; no task sees more than its slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.session import materialize

_INDEX_BITS = 33  # Spark documents: the lower 33 bits count rows within a partition.


def _with_offsets(slices: DataFrame) -> DataFrame:
    """Per slice the amount before it, and the grand total."""
    in_order = Window.orderBy("_slice")
    return slices.select(
        "_slice",
        (F.sum("_amount").over(in_order) - F.col("_amount")).alias("_before"),
        F.sum("_amount").over(Window.partitionBy()).alias("_total"),
        "_amount",
    )


def number_rows(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Number rows 1..n in the given order, which must be unique for a stable result."""
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    written = materialize(placed, "numbered")
    position = F.col("_position")
    sliced = written.withColumns(
        {
            "_slice": F.shiftright(position, _INDEX_BITS),
            "_index": position.bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)),
        }
    )
    counts = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_amount"))
    offsets = F.broadcast(_with_offsets(counts))  # one row per shuffle partition
    numbered = sliced.join(offsets, "_slice").withColumn(name, F.col("_before") + F.col("_index") + 1)
    return numbered.select(*df.columns, name)


def number_rows_in_place(df: DataFrame, group: str, order_by: list[str], name: str) -> DataFrame:
    """``number_rows`` for rows that lie by ``group``, the first column of the order: they stay where they are.

    Only the groups and their sizes are put in order, which says where each group's numbers
    start; within a group rows are ranked. A group stands in one task and has a value."""
    if order_by[0] != group:
        raise ValueError(f"the order must begin with {group}")
    sizes = materialize(df.groupBy(group).agg(F.count(F.lit(1)).alias("_size")), "group_sizes")
    placed = materialize(
        sizes.repartitionByRange(group)
        .sortWithinPartitions(group)
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_position", _INDEX_BITS)),
        "placed_groups",
    )
    totals = placed.groupBy("_slice").agg(F.sum("_size").alias("_amount"))
    offsets = F.broadcast(_with_offsets(totals))  # one row per shuffle partition
    so_far = F.sum("_size").over(Window.partitionBy("_slice").orderBy("_position"))
    starts = placed.join(offsets, "_slice").select(group, (F.col("_before") + so_far - F.col("_size")).alias("_start"))
    start = F.coalesce("_start", F.raise_error(F.lit(f"{group} is empty")).cast("bigint"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order_by))
    numbered = df.join(starts, group, "left").withColumn(name, start + rank)
    return numbered.select(*df.columns, name)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values with their frequency, in ordered slices on disk."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    sliced = counted.repartitionByRange(column).withColumn("_slice", F.spark_partition_id())
    return materialize(sliced, "value_counts")


def quantiles(counts: DataFrame, column: str, at: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours, one row.

    ``counts`` comes from ``value_counts``. Slice totals tell which slices hold
    the wanted ranks; only those are ordered.
    """
    slices = counts.groupBy("_slice").agg(F.sum("_n").alias("_amount"))
    ranked = counts.join(F.broadcast(_with_offsets(slices)), "_slice")  # one row per shuffle partition
    place = {name: (F.col("_total") - 1) * F.lit(p) for name, p in at.items()}
    lower = {name: F.floor(value) for name, value in place.items()}
    upper = {name: F.ceil(value) for name, value in place.items()}
    ranks = [*lower.values(), *upper.values()]

    def holds(rank, start, size):
        return (rank >= start) & (rank < start + size)

    wanted = F.lit(False)
    for rank in ranks:
        wanted = wanted | holds(rank, F.col("_before"), F.col("_amount"))
    within = Window.partitionBy("_slice").orderBy(column)
    placed = ranked.where(wanted).withColumn(
        "_start", F.col("_before") + F.sum("_n").over(within) - F.col("_n")
    )
    value = F.col(column).cast("double")
    parts = []
    for name in at:
        weight = F.max(place[name] - lower[name])
        low = F.max(F.when(holds(lower[name], F.col("_start"), F.col("_n")), value))
        high = F.max(F.when(holds(upper[name], F.col("_start"), F.col("_n")), value))
        parts.append((low * (1 - weight) + high * weight).alias(name))
    return placed.agg(*parts)

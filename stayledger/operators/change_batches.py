"""Compose the five change batches that exercise every history rule.

From one source of numbered rows: an initial load, updates with new keys and
exact duplicates, a replay, a same-state delivery and a reverted state. Used to
test all layers end to end on real rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.cleaning import strip
from stayledger.operators.ordering import number_rows, number_rows_in_place
from stayledger.schema import BATCH_COLUMNS, SOURCE_COLUMNS

NUMBER = "original_source_row_number"
KEY_COLUMNS = ["source_dataset", NUMBER, "booking_key"]


@dataclass(frozen=True)
class Batch:
    batch_id: str
    sequence: int
    effective_at: str


# The batches, which source rows change and how.
INITIAL = Batch("batch_001_initial", 1, "2026-01-01 00:00:00")
UPDATES = Batch("batch_002_updates", 2, "2026-01-02 00:00:00")
REPLAY = Batch("batch_003_duplicate_replay", 3, "2026-01-03 00:00:00")
SAME_STATE = Batch("batch_004_same_state", 4, "2026-01-04 00:00:00")
REVERTED = Batch("batch_005_reverted_state", 5, "2026-01-05 00:00:00")
CHANGED_ROWS = 10
NEW_ROWS = 5
PRICE_RISES = {25: [2], 15: [3, 4, 5]}
FLIPPED_ROWS = [6, 7, 8]
ROOM_CHANGE_ROWS = [9, 10]
REPEATED_ROWS = [2, 3]
LAST_ROOM, FIRST_ROOM = "H", "A"
CHECKED_OUT, CANCELED = "Check-Out", "Canceled"


def with_keys(rows: DataFrame, dataset: str, order_by: list[str], group: str | None = None) -> DataFrame:
    """Number source rows in a given order and derive their stable booking key.

    ``group``: the first column of the order, if the rows lie by it; see ``number_rows_in_place``."""
    numbered = number_rows_in_place(rows, group, order_by, NUMBER) if group else number_rows(rows, order_by, NUMBER)
    return numbered.withColumns(_identity(dataset, F.col(NUMBER)))


def _identity(dataset: str, number: Column) -> dict[str, Column]:
    return {
        "source_dataset": F.lit(dataset),
        NUMBER: number,
        "booking_key": F.concat_ws(":", F.lit(dataset), number.cast("string")),
    }


def _raised(price: Column, by: Column) -> Column:
    """Price plus an amount, at least 0, two decimals; unreadable text counts as 0 without floor."""
    text = strip(price)
    known = F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(text.try_cast("decimal(18,2)"))
    raised = F.greatest(known + by, F.lit(0))
    return F.coalesce(raised, by).cast("decimal(18,2)").cast("string")


def _next_room(room: Column) -> Column:
    letter = F.upper(F.substring(strip(room), 1, 1))
    letter = F.coalesce(F.nullif(letter, F.lit("")), F.lit(FIRST_ROOM))
    return F.when(letter >= LAST_ROOM, FIRST_ROOM).otherwise(F.char(F.ascii(letter) + 1))


def _updated() -> dict[str, Column]:
    """Changed columns of the first rows, by row number."""
    number, adr = F.col(NUMBER), F.col("adr")
    price = adr
    for amount, rows in PRICE_RISES.items():
        price = F.when(number.isin(rows), _raised(adr, F.lit(amount))).otherwise(price)
    flag = F.when(F.trim("is_canceled") == "1", "0").otherwise("1")
    flips, moves = number.isin(FLIPPED_ROWS), number.isin(ROOM_CHANGE_ROWS)
    status = F.when(number == 2, CHECKED_OUT).when(
        flips, F.when(flag == "1", CANCELED).otherwise(CHECKED_OUT)
    )
    changes = F.coalesce(F.nullif(strip(F.col("booking_changes")), F.lit("")), F.lit("0")).cast("int") + 1
    return {
        "adr": price,
        "is_canceled": F.when(flips, flag).otherwise(F.col("is_canceled")),
        "reservation_status": F.coalesce(status, F.col("reservation_status")),
        "assigned_room_type": F.when(moves, _next_room(F.col("assigned_room_type"))).otherwise(
            F.col("assigned_room_type")
        ),
        "booking_changes": F.when(moves, changes.cast("string")).otherwise(F.col("booking_changes")),
    }


def _new_rows(head: DataFrame, dataset: str, source_rows: Column) -> DataFrame:
    """Five new bookings derived from the first five rows."""
    first = head.where(F.col(NUMBER) <= NEW_ROWS)
    return first.withColumns(
        {
            "place": F.col(NUMBER) + CHANGED_ROWS,
            "adr": _raised(F.col("adr"), 10 + F.col(NUMBER)),
            "reservation_status": F.lit(CHECKED_OUT),
            "is_canceled": F.lit("0"),
            **_identity(dataset, source_rows + F.col(NUMBER)),
        }
    )


def _delivery(batch: Batch, row_number: Column, operation: str | Column) -> Column:
    operation = F.lit(operation) if isinstance(operation, str) else operation
    return F.struct(
        F.lit(batch.batch_id).alias("batch_id"),
        F.lit(batch.sequence).alias("batch_sequence"),
        F.lit(batch.effective_at).alias("batch_effective_at"),
        row_number.cast("bigint").alias("batch_row_number"),
        operation.alias("synthetic_operation"),
    )


def _deliver(rows: DataFrame, deliveries: list[Column]) -> DataFrame:
    """One output row per delivery; NULL deliveries are none."""
    batched = rows.withColumn("delivery", F.explode(F.array_compact(F.array(*deliveries))))
    return batched.select("*", "delivery.*").select(*BATCH_COLUMNS, *SOURCE_COLUMNS)


def compose_batches(source: DataFrame, dataset: str) -> DataFrame:
    """All rows of the five batches, in the batch-file layout (times as text).

    ``source`` comes from ``with_keys``: rows numbered 1..n with their key.
    """
    number, one = F.col(NUMBER), F.lit(1)
    originals = _deliver(
        source,
        [
            _delivery(INITIAL, number, "initial"),
            F.when(number == 1, _delivery(SAME_STATE, one, "same_state_fixture")),
            F.when(number == 2, _delivery(REVERTED, one, "reverted_state_fixture")),
        ],
    )
    head = source.where(number <= CHANGED_ROWS)
    last_number = source.select(F.max(NUMBER)).scalar()
    updates = head.withColumns({"place": number, **_updated()})
    changed = updates.unionByName(_new_rows(head, dataset, last_number))
    place = F.col("place")
    kind = (
        F.when(place == 1, "same_state_fixture").when(place <= CHANGED_ROWS, "update").otherwise("new")
    )
    repeat_number = place + (CHANGED_ROWS + NEW_ROWS - REPEATED_ROWS[0] + 1)
    deliveries = _deliver(
        changed,
        [
            _delivery(UPDATES, place, kind),
            F.when(place.isin(REPEATED_ROWS), _delivery(UPDATES, repeat_number, "exact_duplicate")),
            _delivery(REPLAY, place, "duplicate_replay"),
        ],
    )
    return originals.unionByName(deliveries)


def expected_current(dataset: str) -> dict[str, str]:
    """The batches in which bookings 1 and 2 must end up current."""
    return {f"{dataset}:1": SAME_STATE.batch_id, f"{dataset}:2": REVERTED.batch_id}

"""The relations of the warehouse, as one lazy graph or built step by step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stayledger.operators.history import current_state, dealt_by_booking, dedupe_exact, stage
from stayledger.operators.incremental import KEY
from stayledger.operators.marts import DIMENSIONS, MARTS, OF_MART, build_dimension, build_mart, of_mart
from stayledger.operators.metrics import booking_metrics, fact_bookings
from stayledger.operators.saved import SAVED, save_mart
from stayledger.schema import SOURCE_COLUMNS
from stayledger.session import materialize_all, new_path
from stayledger.sources.versions import Versions


def current_bookings(history: DataFrame) -> DataFrame:
    return current_state(dedupe_exact(stage(history)))


def dealt_current(history: DataFrame) -> DataFrame:
    """``current_bookings`` with one shuffle: staged rows are dealt by booking, then both windows run as they lie.

    Map tasks drop nothing before that shuffle, so a booking with very many rows makes one task long."""
    return current_state(dedupe_exact(dealt_by_booking(stage(history))))


def metrics_of(history: DataFrame) -> DataFrame:
    return booking_metrics(current_bookings(history))


def fact_of(history: DataFrame) -> DataFrame:
    return fact_bookings(metrics_of(history))


def serving_relations(metrics: DataFrame) -> dict[str, DataFrame]:
    """Fact, dimensions and marts over one metrics relation."""
    fact = fact_bookings(metrics)
    relations = {"fact_bookings": fact}
    relations |= {name: build_dimension(metrics, name) for name in DIMENSIONS}
    relations |= {name: build_mart(fact, name) for name in MARTS}
    return relations


def plan_warehouse(history: DataFrame) -> dict[str, DataFrame]:
    """Every relation as a lazy view over the history; nothing runs yet."""
    staged = stage(history)
    deduped = dedupe_exact(staged)
    current = current_state(deduped)
    metrics = booking_metrics(current)
    return {
        "staged_history": staged,
        "deduped_history": deduped,
        "current_bookings": current,
        "booking_metrics": metrics,
        **serving_relations(metrics),
    }


def rows_by_booking(history: DataFrame, buckets: int | None = None, dealt: bool = False) -> DataFrame:
    """The staged rows with their source texts, stored by booking in ``buckets`` (by default the
    session's shuffle partitions): what groups or joins by booking needs no further shuffle.

    All rows of a booking stand in one bucket. Rows that are ``dealt`` lie by booking in as many
    partitions already and are written as they stand."""
    spark = history.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return store_bucketed("staged_rows", stage(history if dealt else dealt_by_booking(history, buckets)), buckets)


def store_bucketed(name: str, dealt: DataFrame, buckets: int, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Rows that lie by booking, or by other keys, in ``buckets`` partitions, written as they stand."""
    store = Versions(dealt.sparkSession, new_path(dealt.sparkSession, "base"))
    return store.open(store.write_bucketed(name, [dealt], [*keys], buckets))


def build_warehouse(
    history: DataFrame, warehouse: str | None = None, buckets: int | None = None
) -> dict[str, DataFrame]:
    """The same relations with every shared step done once and stored; see ``build_from_rows``.

    The history is read once, and its wide rows are shuffled once."""
    return build_from_rows(rows_by_booking(history, buckets), warehouse, buckets)


def build_from_rows(
    rows: DataFrame, warehouse: str | None = None, buckets: int | None = None
) -> dict[str, DataFrame]:
    """The relations over ``rows_by_booking`` with as many buckets.

    Written to the working folder are: the staged rows (checks of the history read their
    technical columns and hash only), the current bookings (both windows, bucket by bucket),
    and the dimensions and marts, which hold one row per member or group, so that charts and
    checks do not scan bookings again. The fact is a column selection of the current
    bookings. Dimensions that are the keys of a mart, and the saved aggregates,
    are taken from the stored marts, so bookings are scanned once for each mart
    and for the two dimensions left. Saved aggregates go to ``warehouse``.

    Staged and current rows are both stored by booking, so uniqueness, states per batch and
    distinct bookings are checked bucket by bucket.
    """
    buckets = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    staged = rows.drop(*SOURCE_COLUMNS)
    current = store_bucketed("current_bookings", current_state(dedupe_exact(rows)), buckets)
    metrics = booking_metrics(current)
    serving = serving_relations(metrics)
    fact = serving.pop("fact_bookings")
    stored = materialize_all({name: df for name, df in serving.items() if name not in OF_MART})
    stored |= materialize_all({name: of_mart(stored, name) for name in OF_MART})
    return {
        "staged_history": staged,
        "deduped_history": dedupe_exact(staged),
        "current_bookings": current,
        "booking_metrics": metrics,
        "fact_bookings": fact,
        **{name: stored[name] for name in serving},
        **{name: save_mart(stored[spec.mart], name, warehouse) for name, spec in SAVED.items()},
    }


#: What of a build is kept as tables of the warehouse.
PUBLISHED = ["current_bookings", "booking_metrics", "fact_bookings", *DIMENSIONS, *MARTS]


def store_warehouse(relations: dict[str, DataFrame], warehouse: str) -> int:
    """Write the relations as one version of the warehouse, where any later session finds them.

    All tables change together once the last is written; a run that fails leaves the version before."""
    spark = relations[PUBLISHED[0]].sparkSession
    store = Versions(spark, warehouse)
    return store.commit({name: store.write(name, relations[name]) for name in PUBLISHED})


def open_warehouse(spark: SparkSession, warehouse: str, version: int | None = None) -> dict[str, DataFrame]:
    """The relations that ``store_warehouse`` wrote; marts also under the saved aggregates' names."""
    store = Versions(spark, warehouse)
    tables = store.tables(version)
    found = {name: store.open(tables[name]) for name in PUBLISHED}
    return found | {name: found[spec.mart] for name, spec in SAVED.items()}


def publish(relations: dict[str, DataFrame], names: dict[str, str] | None = None) -> None:
    """Make relations queryable with ``spark.sql`` under their own or the given names.

    Saved aggregates are tables already and need no view of the same name.
    """
    names = names or {}
    for name, df in relations.items():
        if name not in SAVED or name in names:
            df.createOrReplaceTempView(names.get(name, name))

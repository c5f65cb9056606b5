"""Mixing sources to target weights with DataFrame functions only.

Words are summed per source, targets follow from weights and caps, and each document is
emitted ``floor(rate)`` times plus once more when a draw seeded by the hash of its id and text
falls below the rest of the rate. The draws come from a few seeds; each source uses the seed whose
total comes nearest to its target, which keeps small sources with long documents close.

Defined cases: a null text has size 0 and is emitted by its source's rate like any other; a
null source is a source of its own, last in order; rows with equal or null ids draw by their
texts, and only rows equal in id and text draw alike (each counts); an empty table gives no rows; further columns pass through (names starting with
``_mix_`` are reserved and refused).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayledger.session import broadcast_if_small, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # the mix has 3/2 of all words
CAP = 2
#: One MD5 gives four draws of 32 bits.
SALTS = ("a", "b", "c", "d")
SEEDS = 4 * len(SALTS)


def _check_names(docs: DataFrame) -> None:
    if bad := [c for c in docs.columns if c.lower().startswith("_mix_")]:
        raise ValueError(f"reserved column names: {bad}")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def draw_key(doc_id: Column, text: Column) -> Column:
    """What a document's draws depend on: its id and its text, so that rows without ids draw apart."""
    parts = (F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit("")))
    return F.concat_ws(":", *parts)


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the hash of a key."""
    digest = F.md5(F.concat(key, F.lit(SALTS[seed // 4])))
    return F.conv(F.substring(digest, 8 * (seed % 4) + 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """Adds weight and target to (source, source_size).

    The table has one row per source; it is ordered as a whole, so memory grows with the
    number of sources only. Sources in order of cap by weight: one is capped while its cap is
    within its share of what is left. From the first that is not, none is, and all of those
    share what was left there.
    """
    in_order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (place + 1).cast("int"))
    by_cap = Window.orderBy(
        F.col("_cap").cast("double") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary")
    )
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    over, under = share
    ranked = sources.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * cap)
    # everything in units of 1/under words, so that it stays in whole numbers up to one division
    ranked = ranked.withColumns(
        {
            "_left": F.sum("source_size").over(whole) * over
            - F.coalesce(F.sum("_cap").over(before), F.lit(0)) * under,
            "_weights": F.sum("weight").over(after),
        }
    )

    def fair(left, weights):
        return (left * F.col("weight")).cast("double") / (weights * under).cast("double")

    over_cap = F.col("_cap") <= fair(F.col("_left"), F.col("_weights"))
    rest = F.when(~over_cap, F.struct("_left", "_weights"))
    so_far = by_cap.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranked.withColumn("_rest", F.first(rest, ignorenulls=True).over(so_far))
    shared = fair(F.col("_rest._left"), F.col("_rest._weights"))
    target = F.when(F.col("_rest").isNull(), F.col("_cap").cast("double")).otherwise(shared)
    return ranked.withColumn("target", target).drop("_cap", "_left", "_weights", "_rest")


def _choose(narrow: DataFrame, **how) -> tuple[DataFrame, int, int]:
    """Per source its size, target, rate and seed; with the row count and width for the broadcast check."""
    totals = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(totals, **how), "mix_targets")
    bound = targets.agg(F.count(F.lit(1)), F.max(F.octet_length("source"))).first()
    rows, width = bound[0], 64 + (bound[1] or 0)
    size = F.col("source_size")
    targets = targets.withColumn("rate", F.when(size > 0, F.col("target") / size).otherwise(0.0))
    whole = F.floor("rate")
    sized = narrow.join(
        broadcast_if_small(targets.select(F.col("source").alias("_source"), "rate"), rows, width),
        F.col("source").eqNullSafe(F.col("_source")),
    )
    rest = F.col("rate") - whole
    extra = [
        F.sum(F.when(draw(F.col("key"), seed) < rest, F.col("size")).otherwise(0)).alias(f"_{seed}")
        for seed in range(SEEDS)
    ]
    drawn = sized.groupBy("source").agg(*extra).withColumnRenamed("source", "_source")
    miss = [
        F.struct(
            F.abs(size * whole + F.col(f"_{seed}") - F.col("target")).alias("miss"), F.lit(seed).alias("seed")
        )
        for seed in range(SEEDS)
    ]
    chosen = targets.join(drawn, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("source").alias("_mix_source"),
        size.alias("_mix_source_size"),
        F.col("target").alias("_mix_target"),
        F.col("rate").alias("_mix_rate"),
        F.array_min(F.array(*miss))["seed"].alias("_mix_seed"),
    )
    return materialize(chosen, "mix_chosen"), rows, width


def _with_copies(df: DataFrame, choice: tuple[DataFrame, int, int], key: Column) -> DataFrame:
    number = F.lit(1.0)
    for seed in range(SEEDS):
        number = F.when(F.col("_mix_seed") == seed, draw(key, seed)).otherwise(number)
    whole = F.floor("_mix_rate")
    copies = whole + (number < F.col("_mix_rate") - whole).cast("long")
    chosen = broadcast_if_small(*choice)
    return df.join(chosen, F.col("source").eqNullSafe(F.col("_mix_source"))).withColumn("_mix_copies", copies)


def _sizes(docs: DataFrame) -> DataFrame:
    size = word_count(F.col("text"))
    key = draw_key(F.col("doc_id"), F.col("text")).alias("key")
    return materialize(docs.select(F.col("doc_id").alias("id"), "source", size.alias("size"), key), "mix_sizes")


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix: each document as often as it is taken, with its own columns."""
    _check_names(docs)
    key = draw_key(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumn("_mix_key", key)
    planned = _with_copies(keyed, _choose(_sizes(docs), **how), F.col("_mix_key")).where("_mix_copies > 0")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies"))).alias("_mix_copy")
    return planned.select(*[F.col(f"`{c}`") for c in docs.columns], times).drop("_mix_copy")


def mix_digest(docs: DataFrame, **how) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes from it."""
    sizes = _sizes(docs)
    planned = _with_copies(sizes, _choose(sizes, **how), F.col("key"))
    return planned.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("size") * F.col("_mix_copies")).alias("taken"),
    )

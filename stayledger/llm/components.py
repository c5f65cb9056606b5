"""Connected components of links between 64-bit ids, in Spark.

Tasks first shrink their own links to a forest, which keeps a dense group of links near the
number of its members. Then large and small stars alternate: every node passes its
neighbours on to its least neighbour, until nothing changes. A node's neighbours are never
gathered; a hub is an aggregate and a join that Spark splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.session import materialize

LINKS = "a long, b long"

#: Links that a task writes at least, beyond one task a core: a round of few links makes few files.
FILE_LINKS = 1 << 18


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for nodes that are not the least themselves."""
    if not len(a):
        return a, b
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(names)))
    return names[own], names[label[own]]


def _shrink(batches):
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a = np.append(a, batch.column("a").to_numpy())
        b = np.append(b, batch.column("b").to_numpy())
        if len(a) >= 1 << 20:
            a, b = forest(a, b)
    a, b = forest(a, b)
    yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links run from the greater to the lesser id; every node hands its neighbours to the least."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has links; the root is the least id of its component."""
    now = materialize(links.select("a", "b").mapInArrow(_shrink, LINKS), "links")
    seen, rows = None, now.count()
    while True:
        tasks = max(links.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_LINKS))
        now = materialize(_star(_star(now, True), False).coalesce(tasks), "links")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, rows = mark, mark[0]
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)

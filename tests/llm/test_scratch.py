"""Intermediate tables and shuffle files go when what was made of them is stored."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import numpy as np

from stayledger.llm import jaccard_join
from stayledger.session import SHUFFLE_CLEANUP, materialize, new_path, scratch, stored, work_folder


def tables(spark) -> set[str]:
    folder = Path(work_folder(spark).removeprefix("file:"))
    return {p.name for p in folder.iterdir() if p.is_dir()} if folder.exists() else set()


def test_join_leaves_only_what_its_result_reads(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(60))
    docs = make_docs([(k, f"{text} x{k}") for k in range(20)] + [(50, "other words stand here alone")])
    before = tables(spark)
    found = jaccard_join.linked_documents(docs)
    left = {name.rsplit("-", 1)[0] for name in tables(spark) - before}
    assert left == {"jaccard_sets", "jaccard_components"}
    assert {r["component"] for r in found.collect()} == {0, 50}


def test_stored_tables_outlive_their_parts(spark):
    def make():
        part = materialize(spark.range(100).repartition(4), "part")
        inner = stored(spark, "inner", lambda: materialize(part.groupBy().sum("id"), "deep"))
        return inner.withColumnRenamed("sum(id)", "total")

    before, setting = tables(spark), spark.conf.get(SHUFFLE_CLEANUP)
    kept = stored(spark, "kept", make)
    assert kept.first()["total"] == 4950
    assert {name.rsplit("-", 1)[0] for name in tables(spark) - before} == {"kept"}
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_threads_have_their_own_folder(spark):
    with scratch(spark) as folder, ThreadPoolExecutor(1) as pool:
        assert new_path(spark, "x").startswith(folder)
        assert not pool.submit(new_path, spark, "x").result().startswith(folder)


def test_small_batches_are_settled_together():
    """Batches of few nodes are put together, so what a task sends does not grow with their number."""
    pairs = [(np.array([k]), np.array([7], np.uint64)) for k in range(1000)]
    found = list(jaccard_join._portions(pairs))
    assert len(found) == 1 and found[0][0].tolist() == list(range(1000))
    assert list(jaccard_join._portions([])) == []

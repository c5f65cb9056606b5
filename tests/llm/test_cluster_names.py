"""Clusters of near copies are found by few links, and the classifier's scores in one Python worker of a task."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from test_jaccard import brute, family

from stayledger.llm import components, jaccard_join, quality


def test_near_copies_make_few_links(spark, make_docs, monkeypatch):
    """Links of the clusters do not count each code partition in which two copies meet."""
    rng, rows = random.Random(21), []
    for k in range(20):
        rows += family(rng, 100 * k, 15, 200, 2)
    counts, found = [], jaccard_join.components

    def spy(links):
        counts.append(links.count())
        return found(links)

    monkeypatch.setattr(jaccard_join, "components", spy)
    got = jaccard_join.components_digest(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert counts[0] < len(rows)


def test_copies_under_one_name_stay_a_cluster(spark, make_docs):
    """Two near copies with the same least code, which no link of names joins."""
    words = " ".join(f"w{k}" for k in range(200))
    rows = [(1, f"{words} a"), (2, f"{words} b"), (3, "quite another text of a few words")]
    got = jaccard_join.components_digest(make_docs(rows)).collect()
    assert sorted((r[0], r[2]) for r in got) == [(1, 1), (2, 1), (3, 3)]


def test_scores_send_only_texts(spark, make_docs):
    docs = make_docs([(k, f"some words {k} of a text") for k in range(40)] + [(40, None)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    plan = quality.keep_good(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1


def test_context_sums_do_not_depend_on_portions(monkeypatch):
    texts = [f"Some words {k}, and more: word{k % 3} word{k % 3}!" * (k % 5) for k in range(30)] + ["", None]
    batch = pa.record_batch([pa.array([t and t.encode() for t in texts], pa.binary())], names=["text"])

    def sums():
        return [b.column("sums").to_pylist() for b in quality._context_sums([batch, batch])]

    whole = sums()
    monkeypatch.setattr(quality, "STREAM", 50)
    monkeypatch.setattr(quality, "TEXT_CHUNK", 100)
    assert sums() == whole and any(np.frombuffer(x, np.int64).any() for x in whole[0])


def test_rounds_of_few_links_write_few_files(spark, monkeypatch):
    files, stored = [], components.materialize

    def spy(df, name):
        out = stored(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(components, "materialize", spy)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = spark.createDataFrame([(k + 1, k) for k in range(500)], "a long, b long")
        found = components.components(links).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert sorted(tuple(r) for r in found) == [(k, 0) for k in range(501)]
    assert max(files) <= spark.sparkContext.defaultParallelism

"""The pipeline's classifier keeps no copy of the documents beside its result."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from stayledger.llm import quality
from stayledger.session import work_folder


def tables(spark) -> set[str]:
    folder = Path(work_folder(spark).removeprefix("file:"))
    return {p.name for p in folder.iterdir() if p.is_dir()} if folder.exists() else set()


def test_good_documents_leave_no_table(spark, make_docs):
    docs = make_docs([(k, f"some words {k} of a text") for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    before = tables(spark)
    kept = quality.keep_good(docs, labels)
    assert tables(spark) == before
    scores = quality.scored(docs, labels, docs.columns)
    assert sorted(r[0] for r in kept.collect()) == sorted(
        r[0] for r in scores.where(F.col("_q_score") >= quality.THRESHOLD).collect()
    )

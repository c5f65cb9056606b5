"""From raw documents to a training mix: five stages, each written as Parquet and read again.

Each stage gets the documents that the one before kept and returns the columns of
``documents``; the last returns a row for each copy that the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayledger.llm import decontaminate, jaccard_join, mixing, pii, quality
from stayledger.llm.common import arrow_rows
from stayledger.session import materialize

#: Whole texts that pass to a Python worker at once while the join runs its jobs.
TEXTS_AT_ONCE = 1000


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among them."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    with arrow_rows(spark, TEXTS_AT_ONCE):
        return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights ask for."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("jaccard_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("mixing", mixed),
]

#: A trained classifier and latent vectors have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

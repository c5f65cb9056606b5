"""The registered queries of the training-data operators and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayledger.llm import (
    collocations,
    decontaminate,
    jaccard_join,
    licenses,
    mixing,
    oracle,
    pii,
    prefix_trie,
    quality,
    spotsigs,
    substring_dedup,
    suffix_dedup,
    token_lexicon,
    url_filter,
)

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_digest(_table(spark, folder, "documents"))


def op2_pii_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_digest(_table(spark, folder, "documents"))


def op3_latent_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_digest(_table(spark, folder, "documents"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeats_digest(_table(spark, folder, "documents"))


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.components_digest(_table(spark, folder, "documents"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeats_digest(_table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_digest(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.fingerprint_digest(_table(spark, folder, "documents"))


def op10_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_digest(_table(spark, folder, "pages"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie_digest(_table(spark, folder, "conversations"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op13_token_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return token_lexicon.encoding_digest(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_license_scan,
        op2_pii_patterns,
        op3_latent_leaks,
        op4_mix_sources,
        op5_substring_dedup,
        op6_jaccard_join,
        op7_suffix_dedup,
        op8_quality,
        op9_spot_signatures,
        op10_url_templates,
        op11_prefix_trie,
        op12_collocations,
        op13_token_lexicon,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_mix_sources": oracle.MIX_SOURCES,
        "op5_substring_dedup": oracle.REPEATED_WINDOWS,
        "op6_jaccard_join": oracle.JACCARD_JOIN,
        "op7_suffix_dedup": oracle.REPEATED_BYTES,
        "op10_url_templates": oracle.URL_TEMPLATES,
        "op11_prefix_trie": oracle.PREFIX_TRIE,
        "op12_collocations": oracle.COLLOCATIONS,
    }

"""Queries of this package by name, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cantora.llm import ann, collocations, decontaminate, html_text, language_id, near_dedup, packing, prefix_trie, sharding, suffix_dedup, token_cache, toxicity, url_filter
from cantora.llm.common import read_table


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_cache.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search_every(read_table(spark, sf_dir, "embeddings"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("key")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.redirect_filter(read_table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hilbert_shards": op1_hilbert_shards,
        "op2_token_counts": op2_token_counts,
        "op3_nearest_vectors": op3_nearest_vectors,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_language_id": op5_language_id,
        "op6_main_text": op6_main_text,
        "op7_toxicity": op7_toxicity,
        "op8_decontamination": op8_decontamination,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_redirect_filter": op10_redirect_filter,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_repeated_strings": op12_repeated_strings,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    from cantora.llm import checks

    return checks.oracle_sql()

"""The corpus pipeline: language, toxicity, near-duplicates, benchmark leaks, packing.

Each stage takes all its predecessor kept, as written to Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm import decontaminate, language_id, near_dedup, packing, toxicity
from cantora.llm.common import read_table, stored

SURE = 0.5  # posterior probability from which a language is accepted
SIMILARITY = 80  # percent of the union of two shingle sets


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, no letters, or none likelier than all others together."""
    model = language_id.train(docs.where(language_id.training_rows(docs)))
    found = docs.withColumn("_found", language_id.predicted(docs, model))
    accepted = (F.col("_found.lang") != language_id.UNKNOWN) & (F.col("_found.score") >= SURE)
    return found.where(accepted).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic."""
    scorer = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.withColumn("_score", toxicity.score_column(docs, scorer))
    return scored.where("_score < 0.5").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return near_dedup.one_of_each_group(docs, SIMILARITY)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, as it is or with other numbers, names or units."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every piece of every document in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # no stage is a matter of SQL; tests hold each against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs

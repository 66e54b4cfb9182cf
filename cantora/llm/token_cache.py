"""Token counts through a digest cache: texts seen before, under the same tokenizer, are not encoded."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm.common import scratch_folder, stored, tidy
from cantora.llm.tokens import encoder, file_digest

CACHE_SCHEMA = "digest binary, n_tokens long"
LIMIT = 2048


def content_digest(text: Column, collapse_space: bool) -> Column:
    """SHA-256 of the normalised content.

    Normalisation does only what the tokenizer does anyway: where white space never matters, runs of it
    become one space and the ends are trimmed. NULL is the empty text.
    """
    content = F.coalesce(text, F.lit(""))
    if collapse_space:
        content = F.btrim(F.regexp_replace(content, r"[ \t\r\n]+", " "))
    return F.unhex(F.sha2(content, 256))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored (digest, n_tokens) of one tokenizer version; empty where none are stored yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/tokenizer={version}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path.toString())


def encode_misses(misses: DataFrame, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of (digest, text)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(tokenizer).count
        for batch in batches:
            counts = [count(text.as_py()) for text in batch.column("text")]
            yield pa.record_batch({"digest": batch.column("digest").cast(pa.binary()), "n_tokens": pa.array(counts, pa.int64())})

    return misses.select("digest", "text").mapInArrow(tidy(encode, lambda: encoder(tokenizer).forget()), CACHE_SCHEMA)


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text).

    ``tokenizer`` is a file every worker can read, ``cache`` a folder that outlives the job (by default
    a new one in the scratch folder). Texts are reduced to one per digest before the shuffle, so a
    text copied a million times travels once per task and is encoded once; digests in the cache
    under this tokenizer's version are not encoded at all; new counts are appended. Documents then
    take their counts by digest, a join of short rows that adaptive execution splits where hot.

    Defined cases: a NULL text is empty and has no tokens; a NULL doc_id is kept; repeated rows are
    counted each; an empty table gives no rows and an unchanged cache; further columns are ignored.
    """
    spark = docs.sparkSession
    cache = cache or scratch_folder(spark) + "/token_counts"
    version = file_digest(tokenizer)
    digest = content_digest(F.col("text"), encoder(tokenizer).ignores_space)
    texts = docs.select(digest.alias("digest"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["digest"])
    misses = texts.join(read_cache(spark, cache, version).select("digest"), "digest", "left_anti")
    encode_misses(misses, tokenizer).write.mode("append").parquet(f"{cache}/tokenizer={version}")

    # two jobs that append at once may both store a digest; either count serves
    counts = stored(read_cache(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    rows = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), digest.alias("digest"))
    return rows.join(counts, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

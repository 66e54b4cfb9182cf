"""Sharding along a Hilbert curve over metadata, for file pruning on several columns at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import stored, with_position

BITS = 5  # per dimension; three dimensions make 2^15 cells


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``axes`` (points x dimensions, each below 2^bits).

    Skilling's transform ("Programming the Hilbert curve", 2004), over all points at once: undo the
    excess rotations from the top bit down, Gray-decode, then interleave the bits.
    """
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            inverted = (x[i] & q) > 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(inverted, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def hilbert_column(axes: list[Column], bits: int = BITS) -> Column:
    @F.pandas_udf("long")
    def curve(points: pd.Series) -> pd.Series:
        if not len(points):
            return pd.Series([], dtype="int64")
        return pd.Series(hilbert_index(np.vstack(points.to_numpy()), bits))

    return curve(F.array(*[a.cast("int") for a in axes]))


def rank_code(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(value, code): the sorted distinct values of ``column`` cut into at most 2^bits equal runs.

    Codes keep the order of the values, so a run of the curve covers a narrow range of them. NULL is
    the smallest value. The ranking is distributed, as values may be as many as rows.
    """
    distinct = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).select("value")
    placed = with_position(distinct, ["value"])
    total = max(1, placed.count())
    return placed.select("value", F.expr(f"CAST(position * {1 << bits} DIV {total} AS INT)").alias("code"))


def size_code(size: Column, bits: int = BITS) -> Column:
    """Two codes per power of two, from 64 bytes on, up to the last code."""
    code = F.floor(2 * F.log2(F.greatest(size, F.lit(64)).cast("double"))) - 12
    return F.least(code, F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int = 8, bits: int = BITS) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` runs of a Hilbert curve over (lang, source, size).

    Law ``rows``: the curve is cut into runs whose row counts are at most one apart, whatever one cell
    holds; inside a cell, rows are ordered by (text_crc32, doc_id), so equal texts of one cell are
    neighbours. Columns: doc_id, size (UTF-8 bytes + 1), text_crc32 (unsigned), law, shard, slot (place
    in the shard, gapless from 0), grown_shard (NULL under this law), then lang, source and
    hilbert for pruning and audits.

    Defined cases: a NULL text has no bytes (size 1, crc of nothing 0); a NULL lang or source is the
    smallest value; a NULL doc_id comes first; repeated rows get a slot each; an empty table gives no
    rows; further columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    facts = stored(docs.select(
        "doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    ))
    for column in ("lang", "source"):
        codes = rank_code(facts, column, bits).withColumnsRenamed({"value": f"_{column}", "code": f"{column}_code"})
        facts = facts.join(codes, F.col(column).eqNullSafe(F.col(f"_{column}")), "left").drop(f"_{column}")
    axes = [F.col("lang_code"), F.col("source_code"), size_code(F.col("size"), bits)]
    on_curve = facts.withColumn("hilbert", hilbert_column(axes, bits)).drop("lang_code", "source_code")
    placed = with_position(on_curve, ["hilbert", "text_crc32", "doc_id"])
    total = facts.count()
    shard = F.expr(f"position * {shards} DIV {max(1, total)}")
    start = F.expr(f"(shard * {total} + {shards - 1}) DIV {shards}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("position") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "lang", "source", "hilbert",
    )


def manifest(sharded: DataFrame) -> DataFrame:
    """Per shard: rows, bytes and the value ranges a reader prunes files by."""
    ranges = [f(c).alias(f"{n}_{c}") for c in ("lang", "source", "size", "hilbert") for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ranges)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, each shard's rows in curve order."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

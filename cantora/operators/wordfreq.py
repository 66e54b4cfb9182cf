"""Word-frequency marts per track and per album."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.functions import batches
from cantora.functions.metrics import is_stopword, word_tokens
from cantora.functions.text import let
from cantora.functions.wordlists import STOPWORDS


def words(lyrics: DataFrame, key: str = "track_id", stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """(key, word): every occurrence of the words that count."""
    found = lyrics.where(F.col("text").isNotNull()).select(key, F.explode(word_tokens(F.col("text"))).alias("word"))
    return found.where(~is_stopword(F.col("word"), stopwords))


def track_words(lyrics: DataFrame, key: str = "track_id", stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """(track, word, count) of the words that count.

    Stopwords go right after the explode, inside the same generated stage as the map-side
    count, so only (track, word) sums are shuffled.
    """
    return words(lyrics, key, stopwords).groupBy(key, "word").agg(F.count(F.lit(1)).alias("count"))


def packed_counts(lyrics: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """``lyrics`` with ``words`` (the different words that count, sorted, joined by spaces) and ``counts`` for ``text``.

    Row-local: where every track has one row, its words need no shuffle to be counted. Many texts are split and
    counted at once; those with unusual characters are left to the expressions, where sorted words are cut where
    one differs from the one before it. Rows without such words drop out.
    """
    kept = [c for c in lyrics.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    found = F.filter(word_tokens(text), lambda w: ~is_stopword(w, stopwords))

    def runs(words: Column) -> Column:
        cuts = F.filter(
            F.sequence(F.lit(0), F.size(words) - 1), lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        return let(cuts, lambda begins: F.struct(
            F.array_join(F.transform(begins, lambda i: F.get(words, i)), " ").alias("words"),
            F.transform(begins, lambda i, n: F.coalesce(F.get(begins, n + 1), F.size(words)) - i).alias("counts")))

    counted = let(F.sort_array(found), lambda words: F.when(F.size(words) > 0, runs(words)))
    rows = lyrics.select(*kept, "text", batches.word_counts(text, stopwords).alias("__b"))
    rows = rows.select(*kept, F.explode(F.array(F.when(F.col("__b").isNotNull(), F.col("__b")).otherwise(counted))).alias("__w"))
    return rows.where(F.size("__w.counts") > 0).select(*kept, "__w.words", "__w.counts")


def merged_counts(packed: DataFrame, key: str) -> DataFrame:
    """Rows of ``packed_counts`` that lie in the order of ``key`` in their task, as one row a key with the sums.

    Only what one task holds is merged. No table of all words is kept: a key's words are at most in memory.
    """
    wide = packed.withColumn("counts", F.col("counts").cast("array<bigint>"))

    def scan(rows):
        return batches.merge(rows, key)

    return wide.mapInArrow(scan, wide.schema)


def unpacked_counts(packed: DataFrame) -> DataFrame:
    """Rows of ``packed_counts`` as one row a word: the other columns, word and count."""
    kept = [c for c in packed.columns if c not in ("words", "counts")]
    pairs = F.arrays_zip(F.split("words", " ").alias("word"), F.col("counts").alias("count"))
    return packed.select(*kept, F.inline(pairs).alias("word", "count")).withColumn("count", F.col("count").cast("bigint"))


def album_words(per_track: DataFrame, tracks: DataFrame) -> DataFrame:
    """(album, word, count): the track counts summed per album id."""
    track_album = tracks.select(F.col("id").alias("track_id"), "album_id")
    return (
        per_track.join(track_album, "track_id")
        .groupBy("album_id", "word").agg(F.sum("count").alias("count"))
    )

"""Incremental ingest: files that have landed since the last run, cleaned and scored once.

``append_new_files`` is a stream whose checkpoint remembers the files already seen; a rerun without
new files does nothing, and a file counts as new however old it claims to be. ``upsert_files`` compares
the listing with what is stored, so it also takes files that have changed; ``file_changes`` sees deleted ones
too and feeds ``LyricsMarts``, as does ``maintain`` for a stream of changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cantora.functions import sentiment
from cantora.functions import text as T
from cantora.operators.enrich import METRICS_VERSION, with_metrics
from cantora.operators.loading import first_per_key
from cantora.operators.numbering import hash_id
from cantora.plans.refresh import LyricsMarts
from cantora.sources.landed import with_lyrics_scope
from cantora.sources.partitioned import exists


def lyrics_stream(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Stream of lyrics text files below ``<root>/<artist>/<album>``, at most ``max_files`` a batch.

    Files of any age are taken: without ``maxFileAge`` a restored archive would be passed over.
    """
    files = (
        spark.readStream.option("maxFileAge", "36500d")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").option("maxFilesPerTrigger", max_files)
        .text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )
    return with_lyrics_scope(files)


def enriched(lyrics: DataFrame, rules: sentiment.Rules | None = None) -> DataFrame:
    """Header stripped and all metrics added; the same on a stream and on a table."""
    scored = with_metrics(lyrics.withColumn("text", T.strip_header(F.col("text"))), rules=rules)
    return scored.withColumn("metrics_version", F.lit(METRICS_VERSION))


def append_new_files(stream: DataFrame, out: str, checkpoint: str, rules: sentiment.Rules | None = None) -> StreamingQuery:
    """Score the files that are new and append them to a Parquet folder, then stop."""
    return (
        enriched(stream, rules).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, modified) of the lyrics files; no content is read."""
    return _files(spark, root).select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"))


def _files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)


def contents(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """(path, modified, text) of the ``wanted`` files (path, modified), in one job.

    The scan opens only files changed in the span of times of the wanted ones; others in that span are
    dropped by the join. Paths never pass the driver, only the two ends of the span.
    """
    span = wanted.agg(F.min("modified").alias("first"), F.max("modified").alias("last")).first()
    files = _files(spark, root).where(F.col("modificationTime").between(F.lit(span["first"]), F.lit(span["last"])))
    read = files.select(
        F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"),
        F.col("content").cast("string").alias("text"))
    return read.join(wanted.select("path", "modified"), ["path", "modified"], "left_semi")


def upsert_files(spark: SparkSession, root: str, out: str, rules: sentiment.Rules | None = None) -> int:
    """Score files that are new, late or changed, and return their number; ``current`` shows the last row per key.

    A file is taken when its path is not stored with its modification time: the listing is anti-joined with
    what is stored. All of them are one folder, so a run that fails is taken again as a whole.
    """
    files, batch = listed(spark, root), 0
    if exists(spark, out):
        stored = spark.read.parquet(out)
        files = files.join(stored.select("path", "modified"), ["path", "modified"], "left_anti")
        batch = (stored.agg(F.max("batch")).first()[0] or 0) + 1
    if files.isEmpty():
        return 0
    rows = enriched(with_lyrics_scope(contents(spark, root, files)), rules)
    rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")
    return spark.read.parquet(f"{out}/batch={batch}").count()


def file_changes(spark: SparkSession, root: str, ledger: DataFrame) -> DataFrame:
    """What has happened to the files since ``ledger`` (path, modified): rows for ``LyricsMarts.apply``.

    New and changed files come with their text, files that are gone as ``deleted``.
    """
    now = listed(spark, root)
    taken = contents(spark, root, now.join(ledger, ["path", "modified"], "left_anti")).withColumn("deleted", F.lit(False))
    gone = ledger.join(now, "path", "left_anti").select(
        "path", "modified", F.lit(None).cast("string").alias("text"), F.lit(True).alias("deleted"))
    scoped = with_lyrics_scope(taken.unionByName(gone)).withColumn("text", T.strip_header(F.col("text")))
    return scoped.select(
        hash_id(F.col("path")).alias("track_id"), hash_id(F.col("artist_dir"), F.col("album_dir")).alias("album_id"),
        "text", "deleted", "modified", "path")


def maintain(changes: DataFrame, marts: LyricsMarts, checkpoint: str) -> StreamingQuery:
    """Apply a stream of changes batch by batch, then stop; a batch taken twice has the same result."""
    return (
        changes.writeStream.foreachBatch(lambda rows, _: marts.apply(rows)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current(spark: SparkSession, out: str, key: str = "path") -> DataFrame:
    """The upserted table: the row of the latest batch for each key."""
    return first_per_key(spark.read.parquet(out), [F.col(key)], [F.col("batch")], last=True)

"""Landed files to model tables, all artists at once.

Stages are functions from DataFrames to DataFrames. Stage results that several later steps read
are written once and read back, which also keeps them safe from lost executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cantora import schemas
from cantora.functions import coerce, sentiment
from cantora.functions import text as T
from cantora.operators import loading, matching, shape, wordfreq
from cantora.operators.enrich import METRICS_VERSION, refresh_metrics
from cantora.operators.numbering import hash_id
from cantora.operators.shape import pending
from cantora.plans.refresh import LyricsMarts
from cantora.sources import landed, sinks

ALBUM = ("artist_dir", "album_dir")


@dataclass(frozen=True)
class Layout:
    """Where landed files lie and where stage outputs go."""

    catalog: str
    lyrics: str
    profiles: str
    stages: str


def clean_catalog(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Clean tracks of the complete albums, and the audit of albums with unusable rows."""
    tracks, bad = landed.quarantine(landed.read_tracks(spark, layout.catalog), ["Name"])
    albums = landed.read_albums(spark, layout.catalog)
    complete = tracks.select(*ALBUM).distinct().join(albums.select(*ALBUM).distinct(), list(ALBUM))
    joined = shape.join_album_metadata(tracks.join(complete, list(ALBUM), "left_semi"), albums)
    return shape.clean_tracks(joined), landed.failed_albums(bad)


def clean_artists(spark: SparkSession, layout: Layout) -> DataFrame:
    catalog = landed.read_artists(spark, layout.catalog).select(*schemas.ARTIST_CSV.names, F.col("artist_dir").alias("folder"))
    profiles = landed.read_profiles(spark, layout.profiles).select(*schemas.PROFILE_CSV.names)
    return shape.merge_artists(catalog, profiles)


def clean_lyrics(spark: SparkSession, layout: Layout) -> DataFrame:
    return landed.read_lyrics(spark, layout.lyrics).withColumn("text", T.strip_header(F.col("text")))


def join_lyrics(tracks: DataFrame, lyrics: DataFrame) -> DataFrame:
    """Tracks with match columns and lyrics; albums without any lyrics file are left out."""
    keyed = tracks.withColumn("title_key", T.title_key(F.col("SongName")))
    with_files = keyed.join(lyrics.select(*ALBUM).distinct(), list(ALBUM), "left_semi")
    return matching.attach_text(matching.match_lyrics(with_files, lyrics, ALBUM), lyrics)


# ---- load -------------------------------------------------------------------------------


def artist_rows(merged: DataFrame) -> DataFrame:
    """Merged artist attributes as rows of the artists table, plus the folder they belong to."""
    blank = T.blank_to_null
    born = coerce.to_date_lenient(F.col("DateOfBirth"))
    return merged.where(blank(F.col("Name")).isNotNull()).select(
        hash_id(F.col("Name"), born).alias("id"), F.col("Name").alias("name"), blank(F.col("BirthName")).alias("birth_name"),
        born.alias("birth_date"), blank(F.col("PlaceOfBirth")).alias("birth_place"),
        blank(F.col("CountryOfCitizenship")).alias("country"),
        T.strip(F.col("WorkPeriodStart")).try_cast("double").try_cast("int").alias("active_years"),
        T.combine_genres(F.col("GenresWikidata"), F.col("GenresSpotify")).alias("genres"),
        blank(F.col("Instruments")).alias("instruments"), blank(F.col("VoiceType")).alias("vocal_type"),
        F.col("Popularity").alias("popularity"), F.col("Followers").alias("followers"), F.col("ImageURL").alias("image_url"),
        F.coalesce("folder", T.sanitize_hyphen(F.col("Name"))).alias("artist_dir"),
    )


def album_rows(final: DataFrame, artists: DataFrame) -> DataFrame:
    """One row per landed album, from its first track; excluded editions are left out."""
    kept = final.where(~T.excluded_album(F.col("album_dir")))
    first = loading.first_per_key(
        kept.select(*ALBUM, "row_no", "AlbumName", "ReleaseDateAlbum", "AlbumPopularity", "ImageURL"),
        [F.col(c) for c in ALBUM], [F.col("row_no")],
    )
    owned = loading.lookup(first, artists.select("artist_dir", F.col("id").alias("artist_id")), ["artist_dir"])[0]
    return owned.where(F.col("AlbumName").isNotNull()).select(
        hash_id(F.col("AlbumName"), F.col("artist_id")).alias("id"), F.col("AlbumName").alias("name"), "artist_id",
        F.col("ReleaseDateAlbum").alias("release_date"), F.col("AlbumPopularity").alias("popularity"),
        F.col("ImageURL").alias("image_url"), *ALBUM,
    )


def track_rows(final: DataFrame, albums: DataFrame) -> DataFrame:
    """Track rows with their lyrics; the track number is the row number in the album file."""
    placed = loading.lookup(final, albums.select(*ALBUM, F.col("id").alias("album_id")), ALBUM)[0]
    return placed.select(
        hash_id(F.col("SongName"), F.col("album_id")).alias("id"), F.col("SongName").alias("name"), "album_id",
        F.col("row_no").alias("track_number"), F.col("DurationMs").alias("duration_ms"),
        F.col("Explicit").alias("explicit"), F.col("SongPopularity").alias("popularity"),
        F.col("Lyrics").alias("text"), "row_no",
    )


def lyrics_rows(tracks: DataFrame) -> DataFrame:
    empty = {m: F.lit(None).cast(schemas.TABLES["lyrics"][m].dataType) for m in schemas.METRICS}
    return (
        tracks.select(F.col("id").alias("track_id"), "text", "row_no")
        .withColumns(empty).withColumn("metrics_version", F.lit(None).cast("int"))
    )


def load(
    spark: SparkSession, merged: DataFrame, final: DataFrame, database: str | None = None, buckets: int | None = None
) -> None:
    """Insert what is new into the four model tables, parents first."""
    sinks.create_tables(spark, database, buckets)

    def insert(table: str, rows: DataFrame, order: list[str]) -> None:
        # Winners are picked on the table's own columns, lyrics on their key alone: no text is sorted.
        target, keys = sinks.stored(spark, table, database), schemas.NATURAL_KEYS[table]
        wanted = [f.name for f in schemas.TABLES[table].fields if f.name in rows.columns and f.name != "text"]
        narrow = rows.select(*dict.fromkeys([*wanted, *order]))
        fresh = loading.insert_ignore(target, narrow, keys, [F.col(c) for c in order], schemas.NULLABLE_KEYS)
        if "text" in schemas.TABLES[table].fieldNames():
            texts = rows.select(*keys, *order, "text").dropDuplicates([*keys, *order])
            fresh = fresh.join(texts, [*keys, *order])
        sinks.append_rows(fresh, table, database, buckets)

    artists = artist_rows(merged)
    albums = album_rows(final, artists)
    tracks = track_rows(final, albums)
    insert("artists", artists, ["artist_dir"])
    insert("albums", albums, ["album_dir"])
    insert("tracks", tracks, ["row_no"])
    insert("lyrics", lyrics_rows(tracks), ["row_no"])


def analyze(
    spark: SparkSession, database: str | None = None, rules: sentiment.Rules | None = None, buckets: int | None = None
) -> None:
    """Compute missing metrics, then rebuild the two word-frequency tables."""
    stored = sinks.stored(spark, "lyrics", database)
    if not pending(stored, schemas.METRICS, METRICS_VERSION).isEmpty():
        sinks.replace_table(refresh_metrics(stored, rules), "lyrics", database, buckets)
    tracks = sinks.stored(spark, "tracks", database)
    known = tracks.select(F.col("id").alias("track_id"))
    lyrics = sinks.stored(spark, "lyrics", database).join(known, "track_id", "left_semi")
    sinks.replace_table(wordfreq.track_words(lyrics), "word_frequencies_track", database, buckets)
    per_track = sinks.stored(spark, "word_frequencies_track", database)
    sinks.replace_table(wordfreq.album_words(per_track, tracks), "word_frequencies_album", database, buckets)


def placed_lyrics(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(track_id, album_id, text) of the stored tracks with lyrics."""
    tracks = sinks.stored(spark, "tracks", database).select(F.col("id").alias("track_id"), "album_id")
    return sinks.stored(spark, "lyrics", database).select("track_id", "text").join(tracks, "track_id")


def run(
    spark: SparkSession, layout: Layout, database: str | None = None, rules: sentiment.Rules | None = None,
    buckets: int | None = None, marts: LyricsMarts | None = None,
) -> None:
    """Landed files to a complete, analyzed model; ``buckets`` as in ``sinks.create_tables``.

    With ``marts``, metrics and word counts go there and only what has changed is computed again;
    ``StoredModel`` takes them from there. Otherwise the tables of the database are rebuilt.
    """
    out = layout.stages

    counts: dict[str, int] = {}

    def stage(df: DataFrame, name: str, by=("artist_dir",), **counters: Column) -> DataFrame:
        # the counters ride on the write, so no audit needs a scan to learn that it has nothing to say
        seen = Observation(name)
        sinks.write_stage(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counters.items()]), f"{out}/{name}", by)
        counts.update({f"{name}_{n}": v for n, v in seen.get.items()})
        return spark.read.parquet(f"{out}/{name}")

    cleaned, failed = clean_catalog(spark, layout)
    tracks = stage(cleaned, "tracks")
    failed.write.mode("append").parquet(f"{out}/audit/failed_albums")
    merged_df = clean_artists(spark, layout)
    merged_df.write.mode("overwrite").parquet(f"{out}/artists")
    merged = spark.read.parquet(f"{out}/artists")
    lyrics = stage(clean_lyrics(spark, layout), "lyrics")
    final = stage(
        join_lyrics(tracks, lyrics), "final",
        missing=F.col("match_path").isNull(), skipped=T.excluded_album(F.col("album_dir")), empty=F.col("Lyrics") == "",
    )
    rows = spark.createDataFrame(sorted(counts.items()), "name string, n long")
    rows.withColumn("audit_ts", F.current_timestamp()).write.mode("append").parquet(f"{out}/audit/counts")

    audit = landed.match_audit(final, list(ALBUM), "SongName")
    audit.withColumn("audit_ts", F.current_timestamp()).write.mode("append").parquet(f"{out}/audit/matches")
    if counts["final_missing"]:
        missing = final.where("match_path is null")
        landed.failed_lyrics(missing, "SongName").write.mode("append").parquet(f"{out}/audit/failed_lyrics")
    if counts["final_skipped"]:
        skipped = final.where(T.excluded_album(F.col("album_dir"))).select(*ALBUM).distinct()
        skipped.withColumn("audit_ts", F.current_timestamp()).write.mode("append").parquet(f"{out}/audit/skipped_albums")

    load(spark, merged, final, database, buckets)
    if marts is None:
        analyze(spark, database, rules, buckets)
    else:
        marts.sync(placed_lyrics(spark, database))
    tables = {name: sinks.stored(spark, name, database) for name in schemas.TABLES}
    found = loading.violations(tables, schemas.RULES).withColumn("audit_ts", F.current_timestamp())
    found.write.mode("append").parquet(f"{out}/audit/integrity")

"""The canned analyses: artists, albums, tracks, lyrics, words, and four trend reports.

Each takes a model (``plans.model.Model`` or ``plans.tables.StoredModel``) and returns a lazy
DataFrame. Rankings add the id as last sort key, so equal values have one order. NULLs sort as
in PostgreSQL: first when descending, last when ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def all_artists(m) -> DataFrame:
    return m.artists()


def artists_like(m, part: str) -> DataFrame:
    return m.artists().where(F.col("name").ilike(f"%{part}%"))


def artist_genres(m) -> DataFrame:
    return m.artists().select("name", "genres")


def albums_of_artist(m, artist: str) -> DataFrame:
    chosen = m.artists().where(F.col("name") == artist).select(F.col("id").alias("artist_id"))
    return m.albums().join(chosen, "artist_id", "left_semi")


def albums_by_popularity(m) -> DataFrame:
    return m.albums().orderBy(F.desc_nulls_first("popularity"), "id").select("name", "popularity")


def unique_words_per_album(m) -> DataFrame:
    # Distinct words per name straight from the occurrences: they are reduced before their one shuffle.
    albums = m.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album"))
    return (
        m.words_of_albums().join(albums, "album_id")
        .groupBy("album").agg(F.countDistinct("word").alias("unique_words"))
        .orderBy(F.desc("unique_words"), "album")
    )


def tracks_of_album(m, album: str) -> DataFrame:
    chosen = m.albums().where(F.col("name") == album).select(F.col("id").alias("album_id"))
    return m.tracks().join(chosen, "album_id", "left_semi")


def explicit_songs_per_artist(m) -> DataFrame:
    albums = m.albums().select(F.col("id").alias("album_id"), "artist_id")
    artists = m.artists().select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name"))
    # Counted per album before the names come in: the join carries one row per album.
    per_album = m.tracks().where("explicit").groupBy("album_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_album.join(albums, "album_id").join(artists, "artist_id")
        .groupBy("artist_name").agg(F.sum("n").alias("explicit_song_count"))
        .orderBy(F.desc("explicit_song_count"), "artist_name")
    )


def longest_tracks(m, k: int = 20) -> DataFrame:
    albums = m.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album_name"), "artist_id")
    artists = m.artists().select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name"))
    return (
        m.tracks().select(F.col("id").alias("track_id"), F.col("name").alias("track_name"), "duration_ms", "album_id")
        .join(albums, "album_id").join(artists, "artist_id")
        .orderBy(F.desc_nulls_first("duration_ms"), "track_id").limit(k)
        .select("track_name", "duration_ms", "artist_name", "album_name")
    )


def _track_names(m) -> DataFrame:
    return m.tracks().select(F.col("id").alias("track_id"), F.col("name").alias("track"))


def lyrics_of_track(m, track: str) -> DataFrame:
    chosen = _track_names(m).where(F.col("track") == track)
    return m.lyrics().select("track_id", "text").join(chosen, "track_id").select("track", "text")


def lyrics_of_album(m, album: str) -> DataFrame:
    chosen = m.albums().where(F.col("name") == album).select(F.col("id").alias("album_id"))
    tracks = m.tracks().join(chosen, "album_id", "left_semi").select(
        F.col("id").alias("track_id"), F.col("name").alias("track"),
        F.col("track_number" if "track_number" in m.tracks().columns else "id").alias("position"),
    )
    return (
        m.lyrics().select("track_id", "text").join(tracks, "track_id")
        .orderBy(F.asc_nulls_last("position"), "track_id").select("track", "text")
    )


def top_by_metric(m, metric: str, k: int = 10, name: str = "track") -> DataFrame:
    return (
        m.lyrics(metric).select("track_id", metric).join(_track_names(m), "track_id")
        .orderBy(F.desc_nulls_first(metric), "track_id").limit(k)
        .select(F.col("track").alias(name), metric)
    )


def hard_to_read(m, below: float = 50) -> DataFrame:
    """Tracks under a readability score, hardest first.

    The scores are hashed by track before the join. A global sort samples its input, and without
    that boundary the sampling would read and score all texts a second time.
    """
    return (
        m.lyrics("readability_score").where(F.col("readability_score") < below)
        .select("track_id", "readability_score").repartition("track_id").join(_track_names(m), "track_id")
        .orderBy(F.asc_nulls_last("readability_score"), "track_id")
        .select(F.col("track").alias("name"), "readability_score")
    )


def density_per_album(m, k: int = 10) -> DataFrame:
    return (
        m.star("lexical_density").groupBy("artist", "album")
        .agg(F.round(F.avg("lexical_density"), 6).alias("avg_lexical_density"))
        .orderBy(F.desc_nulls_first("avg_lexical_density"), "artist", "album").limit(k)
    )


def ranked_albums(m, k: int = 10) -> DataFrame:
    """Albums of each artist by lexical density, best ``k``.

    The rank comes after the aggregate, so the window sorts albums, not tracks, and the rank
    filter lets each task drop all but ``k`` rows per artist before the shuffle.
    """
    per_album = (
        m.star("lexical_density", "readability_score", "sentiment_score").groupBy("artist", "album")
        .agg(
            F.round(F.avg("lexical_density"), 6).alias("avg_lexical_density"),
            F.round(F.avg("readability_score"), 6).alias("avg_readability_score"),
            F.round(F.avg("sentiment_score"), 6).alias("avg_sentiment_score"),
        )
    )
    best = Window.partitionBy("artist").orderBy(F.desc_nulls_first("avg_lexical_density"), "album")
    return (
        per_album.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("bigint")).orderBy("artist", "rank")
    )


def density_per_artist(m) -> DataFrame:
    return (
        m.star("lexical_density").groupBy("artist")
        .agg(
            F.count("track_id").alias("total_tracks"),
            F.round(F.avg("lexical_density"), 6).alias("avg_lexical_density"),
        )
        .orderBy(F.desc_nulls_first("avg_lexical_density"), "artist")
    )


def readability_per_album(m) -> DataFrame:
    albums = m.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album"))
    tracks = m.tracks().select(F.col("id").alias("track_id"), "album_id")
    return (
        m.lyrics("readability_score").select("track_id", "readability_score")
        .join(tracks, "track_id").join(albums, "album_id").groupBy("album")
        .agg(F.round(F.avg("readability_score"), 6).alias("avg_readability"))
        .orderBy(F.desc_nulls_first("avg_readability"), "album")
    )


def sentiment_extremes(m, highest: bool = True, k: int = 10) -> DataFrame:
    order = F.desc_nulls_first("sentiment_score") if highest else F.asc_nulls_last("sentiment_score")
    return (
        m.star("sentiment_score").orderBy(order, "track_id").limit(k)
        .select("artist", "album", "track", "sentiment_score")
    )


def top_words_of_track(m, track: str, k: int = 10) -> DataFrame:
    chosen = _track_names(m).where(F.col("track") == track).select("track_id")
    return (
        m.track_words_of(chosen)
        .orderBy(F.desc("count"), "word", "track_id").limit(k).select("word", "count")
    )


def _albums_named(m, artist: str, album: str | None = None) -> DataFrame:
    artists = m.artists().where(F.col("name") == artist).select(F.col("id").alias("artist_id"))
    albums = m.albums() if album is None else m.albums().where(F.col("name") == album)
    return albums.join(artists, "artist_id", "left_semi").select(F.col("id").alias("album_id"))


def top_words_of_album(m, artist: str, album: str, k: int = 10) -> DataFrame:
    return (
        m.album_words_of(_albums_named(m, artist, album))
        .orderBy(F.desc("count"), "word", "album_id").limit(k).select("word", "count")
    )


def top_words_of_artist(m, artist: str, k: int = 10) -> DataFrame:
    return (
        m.album_words_of(_albums_named(m, artist))
        .groupBy("word").agg(F.sum("count").alias("total_count"))
        .orderBy(F.desc("total_count"), "word").limit(k)
    )


def compare_artists(m, artists: Sequence[str] | None = None) -> DataFrame:
    """Average metrics of artists side by side."""
    metrics = ("lexical_density", "readability_score", "sentiment_score", "word_count")
    star = m.star(*metrics)
    if artists is not None:
        star = star.where(F.col("artist").isin(list(artists)))
    return star.groupBy("artist").agg(
        F.count("track_id").alias("total_tracks"),
        *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in metrics],
    )


def motifs_by_album(m, motifs: Sequence[str]) -> DataFrame:
    """Counts of chosen words by album, one column per word."""
    albums = m.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album"))
    return (
        m.album_words().where(F.col("word").isin(list(motifs))).join(albums, "album_id")
        .groupBy("album_id", "album").pivot("word", list(motifs)).agg(F.sum("count"))
        .na.fill(0, list(motifs))
    )


def sentiment_by_year(m) -> DataFrame:
    return (
        m.star("sentiment_score").groupBy(F.year("release_date").cast("bigint").alias("year"))
        .agg(F.count("track_id").alias("total_tracks"), F.round(F.avg("sentiment_score"), 6).alias("avg_sentiment"))
    )


def explicit_share_by_year(m) -> DataFrame:
    tracks = m.tracks()
    if "release_date" not in tracks.columns:
        albums = m.albums().select(F.col("id").alias("album_id"), "release_date")
        tracks = tracks.join(albums, "album_id")
    return (
        tracks.groupBy(F.year("release_date").cast("bigint").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("total_tracks"),
            F.round(F.avg(F.col("explicit").cast("int")), 6).alias("explicit_share"),
        )
    )

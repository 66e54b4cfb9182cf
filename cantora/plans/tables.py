"""The model over stored tables, with the same methods as the stand-in model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.plans.refresh import LyricsMarts
from cantora.sources.sinks import stored


#: Tables that incremental marts hold in place of the database.
MARTS = {"lyrics": "lyrics", "word_frequencies_track": "words_track", "word_frequencies_album": "words_album"}


class StoredModel:
    """Model tables of one database, for the canned analyses in ``plans.catalog``.

    With ``marts``, lyrics with metrics and word counts are read from there.
    """

    def __init__(self, spark: SparkSession, database: str | None = None, marts: LyricsMarts | None = None):
        self.spark, self.database, self.marts = spark, database, marts

    def _table(self, name: str) -> DataFrame:
        if self.marts is not None and name in MARTS:
            return self.marts.read(self.spark, MARTS[name])
        return stored(self.spark, name, self.database)

    def artists(self) -> DataFrame:
        return self._table("artists")

    def albums(self) -> DataFrame:
        return self._table("albums")

    def tracks(self) -> DataFrame:
        return self._table("tracks")

    def lyrics(self, *metrics: str) -> DataFrame:
        return self._table("lyrics")

    def track_words(self) -> DataFrame:
        return self._table("word_frequencies_track")

    def words_of_albums(self) -> DataFrame:
        return self.album_words().select("album_id", "word")

    def album_words(self) -> DataFrame:
        return self._table("word_frequencies_album")

    def track_words_of(self, tracks: DataFrame) -> DataFrame:
        return self.track_words().join(tracks, "track_id", "left_semi")

    def album_words_of(self, albums: DataFrame) -> DataFrame:
        return self.album_words().join(albums, "album_id", "left_semi")

    def star(self, *metrics: str) -> DataFrame:
        tracks = self.tracks().select(F.col("id").alias("track_id"), F.col("name").alias("track"), "album_id", "explicit")
        albums = self.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album"), "artist_id", "release_date")
        artists = self.artists().select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
        return (
            self.lyrics().select("track_id", *metrics)
            .join(tracks, "track_id").join(albums, "album_id").join(artists, "artist_id")
        )

    def create_views(self) -> None:
        """Register the six tables as temporary views for ad-hoc SQL."""
        for name in ("artists", "albums", "tracks", "lyrics", "word_frequencies_track", "word_frequencies_album"):
            self._table(name).createOrReplaceTempView(name)

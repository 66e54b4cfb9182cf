"""The music model over the generic test tables.

nation/region play artists, customer albums, orders tracks, documents lyrics. Every frame is a
lazy projection, so a query reads only the columns it uses.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.functions.sentiment import Rules
from cantora.functions.text import stem_key, title_key
from cantora.operators import wordfreq
from cantora.operators.enrich import spread, with_metrics

# The test prose is invented, so ratings and rule words are given to some of its words; the
# rules themselves are the library's.
STANDIN_VALENCE = {"thin": 1.9, "reth": -2.3, "shing": 2.7, "onre": -1.4, "mente": 1.1, "heit": -0.8, "tion": 3.1}
STANDIN_RULES = Rules().extended(
    STANDIN_VALENCE, boosters_up=("the", "of"), boosters_down=("and",), negations=("is", "que", "der")
)


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read with its fixed schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def artists(self) -> DataFrame:
        regions = self.raw("region")
        return self.raw("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("genres")
        )

    def albums(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").cast("bigint").alias("artist_id"),
            F.floor("c_acctbal").cast("bigint").alias("popularity"),
        )

    def tracks(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("name"),
            F.col("o_custkey").alias("album_id"),
            F.floor("o_totalprice").cast("bigint").alias("duration_ms"),
            (F.col("o_orderstatus") == "F").alias("explicit"),
            F.col("o_orderdate").cast("date").alias("release_date"),
        )

    def lyrics(self, *metrics: str) -> DataFrame:
        base = self.raw("documents").select(F.col("doc_id").alias("track_id"), "text")
        return with_metrics(spread(base, "track_id"), only=metrics, rules=STANDIN_RULES) if metrics else base

    def track_words(self) -> DataFrame:
        return wordfreq.track_words(spread(self.lyrics(), "track_id"))

    def placed_lyrics(self) -> DataFrame:
        """(album_id, text): spread before the join, so that a small table of tracks does not leave all texts in one task."""
        albums = self.tracks().select(F.col("id").alias("track_id"), "album_id")
        return spread(self.lyrics(), "track_id").join(albums, "track_id").select("album_id", "text")

    def album_words(self) -> DataFrame:
        """Words counted per album in one shuffle: texts meet their album before they are split."""
        return wordfreq.track_words(self.placed_lyrics(), key="album_id")

    def words_of_albums(self) -> DataFrame:
        """(album_id, word), with repeats: for counts that need no sums of their own."""
        return wordfreq.words(self.placed_lyrics(), key="album_id")

    def track_words_of(self, tracks: DataFrame) -> DataFrame:
        """Word counts of some tracks (by track_id): only their texts are split."""
        return wordfreq.track_words(self.lyrics().join(tracks, "track_id", "left_semi"))

    def album_words_of(self, albums: DataFrame) -> DataFrame:
        """Word counts of some albums (by album_id)."""
        tracks = self.tracks().join(albums, "album_id", "left_semi")
        wanted = tracks.select(F.col("id").alias("track_id"))
        return wordfreq.album_words(self.track_words_of(wanted), tracks)

    def star(self, *metrics: str) -> DataFrame:
        """lyrics, tracks, albums and artists joined: ids, names, release date and metrics."""
        lyrics = self.lyrics(*metrics).select("track_id", *metrics)
        tracks = self.tracks().select(
            F.col("id").alias("track_id"), F.col("name").alias("track"), "album_id", "explicit", "release_date"
        )
        albums = self.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album"), "artist_id")
        artists = self.artists().select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
        return lyrics.join(tracks, "track_id").join(albums, "album_id").join(artists, "artist_id")

    # ---- matching: whole part names, those of small parts as tracks, of large ones as files -----

    def titles(self) -> DataFrame:
        return self.raw("part").where("p_size <= 25").select(
            F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand"), F.col("p_name").alias("title"),
            title_key(F.col("p_name")).alias("title_key"),
        )

    def files(self) -> DataFrame:
        return self.raw("part").where("p_size > 25").select(
            F.col("p_brand").alias("brand"), F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("path"),
            stem_key(F.col("p_name")).alias("stem_key"), F.concat_ws(" ", "p_name", "p_type").alias("text"),
        )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

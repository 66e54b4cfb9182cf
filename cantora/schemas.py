"""Schemas of landed files and the table catalog of the model."""

from __future__ import annotations

from pyspark.sql import types as T

from cantora.operators.loading import ChildOf, Rule


TEXT, INT, LONG, REAL, FLAG, DAY = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType()
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, TEXT) for name in names])


# Column names of the landed files and of the model tables.

# ---- landed files -----------------------------------------------------------------------

TRACK_CSV = _texts("Name", "Artists", "Album", "Release Date", "Popularity", "Explicit", "Duration (ms)")
ALBUM_CSV = _texts(
    "Name", "Release Date", "Total Tracks", "Label", "Popularity", "Genres", "Album Type", "URI", "ImageURL"
)
ARTIST_CSV = _texts("Name", "Genres", "Followers", "Popularity", "URI")
PROFILE_CSV = _texts(
    "Artist", "BirthName", "DateOfBirth", "PlaceOfBirth", "CountryOfCitizenship", "WorkPeriodStart",
    "Genres", "Instruments", "VoiceType", "ImageURL",
)
FINAL_CSV = _texts(
    "SongName", "SongPopularity", "Explicit", "DurationMs", "AlbumName", "ReleaseDateAlbum",
    "AlbumPopularity", "ImageURL", "Lyrics",
)
MERGED_ARTIST_CSV = _texts(
    "Name", "BirthName", "DateOfBirth", "PlaceOfBirth", "CountryOfCitizenship", "WorkPeriodStart",
    "GenresWikidata", "GenresSpotify", "Instruments", "VoiceType", "Popularity", "Followers", "ImageURL",
)

_named = T.ArrayType(_struct(name=TEXT))
ARTIST_JSON = _struct(
    name=TEXT, genres=T.ArrayType(TEXT), followers=_struct(total=LONG), popularity=INT, uri=TEXT
)
ALBUM_JSON = _struct(
    name=TEXT, release_date=TEXT, total_tracks=INT, label=TEXT, popularity=INT, genres=T.ArrayType(TEXT),
    album_type=TEXT, uri=TEXT, images=T.ArrayType(_struct(url=TEXT)),
)
TRACK_JSON = _struct(
    name=TEXT, artists=_named, album=_struct(name=TEXT, release_date=TEXT), popularity=INT, explicit=FLAG,
    duration_ms=LONG,
)
PAGE_JSON = _struct(items=T.ArrayType(_struct(id=TEXT, name=TEXT)), next=TEXT)
# The value of a claim is polymorphic, so it stays JSON text.
CLAIMS_JSON = _struct(
    artist=TEXT,
    claims=T.MapType(TEXT, T.ArrayType(_struct(mainsnak=_struct(datavalue=_struct(value=TEXT))))),
)

# ---- model ------------------------------------------------------------------------------

METRICS = ("readability_score", "sentiment_score", "word_count", "line_count", "char_count", "lexical_density")

TABLES: dict[str, T.StructType] = {
    "artists": _struct(
        id=LONG, name=TEXT, birth_name=TEXT, birth_date=DAY, birth_place=TEXT, country=TEXT, active_years=INT,
        genres=TEXT, instruments=TEXT, vocal_type=TEXT, popularity=LONG, followers=LONG, image_url=TEXT,
    ),
    "albums": _struct(id=LONG, name=TEXT, artist_id=LONG, release_date=DAY, popularity=LONG, image_url=TEXT),
    "tracks": _struct(
        id=LONG, name=TEXT, album_id=LONG, track_number=LONG, duration_ms=LONG, explicit=FLAG, popularity=LONG
    ),
    "lyrics": _struct(
        track_id=LONG, text=TEXT, readability_score=REAL, sentiment_score=REAL, word_count=LONG, line_count=LONG,
        char_count=LONG, lexical_density=REAL, metrics_version=INT,
    ),
    "word_frequencies_track": _struct(track_id=LONG, word=TEXT, count=LONG),
    "word_frequencies_album": _struct(album_id=LONG, word=TEXT, count=LONG),
}

NATURAL_KEYS = {
    "artists": ("name", "birth_date"),
    "albums": ("name", "artist_id"),
    "tracks": ("name", "album_id"),
    "lyrics": ("track_id",),
    "word_frequencies_track": ("track_id", "word"),
    "word_frequencies_album": ("album_id", "word"),
}
NULLABLE_KEYS = ("birth_date",)

# Keys of the joins between large tables.
BUCKET_KEYS = {
    "tracks": "id", "lyrics": "track_id", "word_frequencies_track": "track_id", "word_frequencies_album": "album_id",
}

LINKS = (
    ChildOf("albums", "artist_id", "artists"),
    ChildOf("tracks", "album_id", "albums"),
    ChildOf("lyrics", "track_id", "tracks"),
    ChildOf("word_frequencies_track", "track_id", "tracks"),
    ChildOf("word_frequencies_album", "album_id", "albums"),
)

RULES = (
    *[Rule("unique", t, k) for t, k in NATURAL_KEYS.items()],
    *[Rule("foreign", link.table, (link.column,), link.parent) for link in LINKS],
    *[Rule("not_null", t, ("name",)) for t in ("artists", "albums", "tracks")],
    *[Rule("not_null", t, ("word", "count")) for t in ("word_frequencies_track", "word_frequencies_album")],
)

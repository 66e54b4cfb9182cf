"""Column shaping and the two cleaning joins of the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.functions import coerce, text

# Columns dropped, renamed and published by the cleaning stages.
DROPPED = ("Name_album", "Total Tracks", "Label", "Genres", "Album Type", "URI", "Artists", "Release Date")
RENAMED = {
    "Name": "SongName",
    "Popularity": "SongPopularity",
    "Popularity_album": "AlbumPopularity",
    "Album": "AlbumName",
    "Duration (ms)": "DurationMs",
    "Release Date_album": "ReleaseDateAlbum",
}
TRACK_COLUMNS = (
    "SongName", "SongPopularity", "Explicit", "DurationMs",
    "AlbumName", "ReleaseDateAlbum", "AlbumPopularity", "ImageURL",
)
ARTIST_COLUMNS = (
    "Name", "BirthName", "DateOfBirth", "PlaceOfBirth", "CountryOfCitizenship",
    "WorkPeriodStart", "GenresWikidata", "GenresSpotify", "Instruments",
    "VoiceType", "Popularity", "Followers", "ImageURL",
)


def drop_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*names)


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are not there are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def select_present(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in [*keep, *wanted] if c in have])


def convert_present(df: DataFrame, conversions: Mapping[str, object]) -> DataFrame:
    """Apply column functions to the columns that exist."""
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c, fn in conversions.items() if c in df.columns})


def suffix_collisions(df: DataFrame, other: Sequence[str], suffix: str) -> DataFrame:
    """Rename the columns that ``other`` has too; names compare without case, as in SQL."""
    taken = {c.lower() for c in other}
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c.lower() in taken})


def join_album_metadata(tracks: DataFrame, albums: DataFrame, scope: Sequence[str] = ("artist_dir", "album_dir")) -> DataFrame:
    """Tracks left-joined with the metadata of their album by album name.

    ``scope`` columns, present on both sides, tie the join to one landed album; the album's
    name can repeat inside it, which multiplies the track rows as a left join does.
    """
    scope = [c for c in scope if c in tracks.columns and c in albums.columns]
    right = suffix_collisions(albums, tracks.columns, "_album")
    match = F.col("Album") == F.col("Name_album")
    for c in scope:
        match = match & (F.col(c) == F.col(f"{c}_album"))
    return tracks.join(right, match, "left").drop(*[f"{c}_album" for c in scope])


def clean_tracks(joined: DataFrame, keep: Sequence[str] = ("artist_dir", "album_dir", "row_no")) -> DataFrame:
    """Track table in its published shape, from whatever of the columns is there."""
    slim = rename_present(drop_present(joined, DROPPED), RENAMED)
    typed = convert_present(
        slim,
        {
            "ReleaseDateAlbum": coerce.to_date_lenient,
            "SongPopularity": coerce.to_int_or_zero,
            "Explicit": coerce.to_bool,
            "DurationMs": coerce.to_int_or_zero,
            "AlbumPopularity": coerce.to_int_or_zero,
        },
    )
    return select_present(typed, TRACK_COLUMNS, [k for k in keep if k in typed.columns])


def merge_artists(catalog: DataFrame, profiles: DataFrame, keep: Sequence[str] = ("folder",)) -> DataFrame:
    """Catalog and profile attributes of each artist, joined on the artist's name.

    Names are compared without case and outer spaces; an artist known to one source only stays.
    ``keep`` names further columns that pass through.
    """
    left = rename_present(drop_present(catalog, ["URI"]), {"Genres": "GenresSpotify"})
    right = rename_present(profiles, {"Genres": "GenresWikidata"})
    left = left.withColumn("__l", F.lower(text.strip(F.col("Name"))))
    right = suffix_collisions(right, left.columns, "_profile").withColumn("__r", F.lower(text.strip(F.col("Artist"))))
    merged = (
        left.join(right, F.col("__l") == F.col("__r"), "full")
        .withColumn("Name", F.coalesce("Name", "Artist"))
        .drop("__l", "__r", "Artist")
    )
    typed = convert_present(
        merged,
        {
            "DateOfBirth": coerce.iso_date_text,
            "Followers": coerce.to_int_or_zero,
            "Popularity": coerce.to_int_or_zero,
        },
    )
    return select_present(typed, ARTIST_COLUMNS, keep)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def pending(df: DataFrame, metrics: Sequence[str], version: int | None = None) -> DataFrame:
    """Rows still to be computed: some metric is NULL.

    With ``version``, rows already handled by that version are left out, so a metric that is
    rightly NULL is not retried for ever.
    """
    todo = df.where(any_null(metrics))
    if version is None:
        return todo
    return todo.where(F.coalesce(F.col("metrics_version"), F.lit(-1)) < version)

"""Landed files to DataFrames: CSV, JSON, text and HTML, plus the audit views over them.

Layout: ``<root>/<artist>/<album>/<file>``. The columns ``artist_dir`` and ``album_dir`` come from
the path, so one read covers all artists. Schemas are fixed; nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cantora import schemas
from cantora.functions import claims as C
from cantora.functions import text as X

CORRUPT = "_corrupt_record"


def path_part(path: Column, from_end: int) -> Column:
    """Decoded path segment; 1 is the file name, 2 its folder, and so on.

    File paths come back URI-encoded, with a plus sign left as it is.
    """
    segment = F.try_element_at(F.split(path, "/"), F.lit(-from_end))
    return F.url_decode(F.replace(segment, F.lit("+"), F.lit("%2B")))


def stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"\.[^.]*$", "")


def _csv(spark: SparkSession, glob: str, schema: T.StructType) -> DataFrame:
    """CSV files with a header; cells may hold line breaks and doubled quotes.

    ``multiLine`` keeps a file in one task, so row order inside a file is its line order.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .csv(glob)
        .withColumn("path", F.col("_metadata.file_path"))
    )


def number_rows(df: DataFrame, path: str = "path", out: str = "row_no") -> DataFrame:
    """Row number inside each file, from 1.

    A file is read by one task, so the scan's running id is gapless inside it; less the file's
    smallest id it is the row number. That needs one small aggregate and no sort.
    """
    marked = df.withColumn("__at", F.monotonically_increasing_id())
    first = marked.groupBy(F.col(path).alias("__path")).agg(F.min("__at").alias("__first"))
    return (
        marked.join(first, F.col(path) == F.col("__path"))
        .withColumn(out, F.col("__at") - F.col("__first") + 1)
        .drop("__at", "__first", "__path")
    )


def _album_scope(df: DataFrame) -> DataFrame:
    return df.withColumns({"artist_dir": path_part(F.col("path"), 3), "album_dir": path_part(F.col("path"), 2)})


def read_tracks(spark: SparkSession, root: str) -> DataFrame:
    """Track CSVs ``<artist>/<album>/<album>.csv`` with their folders and row_no."""
    rows = _csv(spark, f"{root}/*/*/*.csv", schemas.TRACK_CSV).where(~F.endswith("path", F.lit("_album_metadata.csv")))
    return _album_scope(number_rows(rows))


def read_albums(spark: SparkSession, root: str) -> DataFrame:
    """Album metadata CSVs ``<artist>/<album>/<album>_album_metadata.csv``."""
    return _album_scope(_csv(spark, f"{root}/*/*/*_album_metadata.csv", schemas.ALBUM_CSV))


def _first_row(df: DataFrame) -> DataFrame:
    return number_rows(df).where("row_no = 1").drop("row_no")


def read_artists(spark: SparkSession, root: str) -> DataFrame:
    """Artist CSVs ``<artist>/<artist>_metadata.csv``: the first row of each."""
    rows = _csv(spark, f"{root}/*/*_metadata.csv", schemas.ARTIST_CSV)
    return _first_row(rows).withColumn("artist_dir", path_part(F.col("path"), 2))


def read_profiles(spark: SparkSession, root: str) -> DataFrame:
    """Artist profile CSVs ``<artist>/<file>.csv``: the first row of each."""
    return _first_row(_csv(spark, f"{root}/*/*.csv", schemas.PROFILE_CSV)).withColumn("artist_dir", path_part(F.col("path"), 2))


def read_final_albums(spark: SparkSession, root: str) -> DataFrame:
    """Final album CSVs ``<artist>/<album>/<album>_final.csv``, lyrics cell included."""
    return _album_scope(number_rows(_csv(spark, f"{root}/*/*/*_final.csv", schemas.FINAL_CSV)))


def read_merged_artists(spark: SparkSession, root: str) -> DataFrame:
    """Merged artist CSVs ``<artist>/<artist>_merged_metadata.csv``: the first row of each."""
    rows = _csv(spark, f"{root}/*/*_merged_metadata.csv", schemas.MERGED_ARTIST_CSV)
    return _first_row(rows).withColumn("artist_dir", path_part(F.col("path"), 2))


def read_lyrics(spark: SparkSession, root: str) -> DataFrame:
    """Lyrics text files ``<artist>/<album>/<title>.txt``, one row per file.

    Spark's file listing leaves out files of zero bytes, so their tracks count as missing; their
    lyrics are the empty text either way.
    """
    files = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
        .text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )
    return with_lyrics_scope(files)


def with_lyrics_scope(files: DataFrame) -> DataFrame:
    """Artist, album, title and match key of lyrics files, from their path."""
    named = _album_scope(files).withColumn("title", stem(path_part(F.col("path"), 1)))
    return named.withColumn("stem_key", X.stem_key(F.col("title")))


def quarantine(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and the rows that failed to parse or miss a required column."""
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    for c in required:
        bad = bad | X.blank_to_null(F.col(f"`{c}`")).isNull()
    return df.where(~bad).drop(CORRUPT), df.where(bad)


def failed_albums(bad_rows: DataFrame) -> DataFrame:
    """Audit of albums with unusable rows: artist, album and their log line."""
    return bad_rows.select(F.col("artist_dir").alias("artist"), F.col("album_dir").alias("album")).distinct().withColumns(
        {"line": F.concat_ws("|||", "artist", "album"), "audit_ts": F.current_timestamp()}
    )


def failed_lyrics(missing: DataFrame, song: str, reason: str = "No lyrics found") -> DataFrame:
    """Audit of songs without lyrics: time, artist, album, song, reason."""
    return missing.select(
        F.current_timestamp().alias("audit_ts"), F.col("artist_dir").alias("artist"), F.col("album_dir").alias("album"), F.col(f"`{song}`").alias("song"), F.lit(reason).alias("reason")
    )


def match_audit(matched: DataFrame, keep: Sequence[str], song: str, match_path: str = "match_path") -> DataFrame:
    """Audit of a match: ``song --> file`` for hits, the song alone for misses."""
    hit = F.col(match_path).isNotNull()
    return matched.select(
        *keep,
        F.when(hit, F.lit("matched")).otherwise(F.lit("missing")).alias("outcome"),
        F.when(hit, F.concat_ws(" --> ", F.col(song), path_part(F.col(match_path), 1))).otherwise(F.col(song)).alias("line"),
        "tier", "score",
    )


def album_summary(tracks: DataFrame, has_text: str, number: str = "track_no", title: str = "title", url: str = "url") -> DataFrame:
    """Summary of an album's lyrics: number, title, flag, address."""
    found = F.coalesce(F.col(has_text), F.lit(False))
    return tracks.select(
        number, title,
        F.when(found, F.lit("✅")).otherwise(F.lit("❌")).alias("has_lyrics"),
        F.when(found, F.coalesce(F.col(url), F.lit("N/A"))).otherwise(F.lit("N/A")).alias("url"),
    )


# ---- nested payloads --------------------------------------------------------------------


def variant_items(df: DataFrame, value: str) -> DataFrame:
    """One row (``item_pos``, ``item_key``, ``item``) per element of a VARIANT array or member of an object.

    A value of any other kind has no rows. ``item_key`` is NULL in arrays.
    """
    items = df.sparkSession.tvf.variant_explode(F.col(value).outer())
    named = df.lateralJoin(items.select(
        F.col("pos").cast("long").alias("item_pos"), F.col("key").alias("item_key"), F.col("value").alias("item")))
    return named


def claim_rows(payload: DataFrame, text: str = "payload") -> DataFrame:
    """Claims of raw JSON payloads without a fixed schema: the other columns and property, n, kind, text, time.

    A property may hold a list of claims or a single one, a value may be an object, a string or a number, and
    any field may be absent or of another type. What is no JSON at all has no rows.
    """
    kept = [c for c in payload.columns if c != text]
    claims = payload.select(*kept, F.try_variant_get(F.try_parse_json(text), "$.claims", "variant").alias("claims"))
    held = variant_items(claims, "claims").select(*kept, F.col("item_key").alias("property"), F.col("item").alias("list"))
    listed = variant_items(held, "list").where("item_key is null").select(*kept, "property", F.col("item_pos").alias("n"), F.col("item").alias("claim"))
    single = held.where(C.variant_kind(F.col("list")) == "object").select(
        *kept, "property", F.lit(0).cast("long").alias("n"), F.col("list").alias("claim"))
    value = F.try_variant_get("claim", "$.mainsnak.datavalue.value", "variant")
    return listed.unionByName(single).withColumn("value", value).where("value is not null").select(
        *kept, "property", "n", C.variant_kind(F.col("value")).alias("kind"), C.variant_text(F.col("value")).alias("text"),
        C.variant_field(F.col("value"), "time").alias("time"))


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def flatten_artists(payload: DataFrame) -> DataFrame:
    return payload.select(
        F.col("name").alias("Name"), X.join_names(F.coalesce("genres", F.array().cast("array<string>"))).alias("Genres"),
        F.col("followers.total").cast("string").alias("Followers"), F.col("popularity").cast("string").alias("Popularity"),
        F.col("uri").alias("URI"),
    )


def flatten_albums(payload: DataFrame) -> DataFrame:
    return payload.select(
        F.col("name").alias("Name"), F.col("release_date").alias("Release Date"),
        F.col("total_tracks").cast("string").alias("Total Tracks"), F.col("label").alias("Label"),
        F.col("popularity").cast("string").alias("Popularity"),
        X.join_names(F.coalesce("genres", F.array().cast("array<string>"))).alias("Genres"),
        F.col("album_type").alias("Album Type"), F.col("uri").alias("URI"), C.first_image(F.col("images")).alias("ImageURL"),
    )


def flatten_tracks(payload: DataFrame) -> DataFrame:
    """Flat track rows; empty payloads are left out."""
    names = F.transform(F.coalesce("artists", F.array().cast("array<struct<name:string>>")), lambda a: a["name"])
    return payload.where(F.coalesce("name", "album.name", F.col("duration_ms").cast("string")).isNotNull()).select(
        F.col("name").alias("Name"), X.join_names(names).alias("Artists"), F.col("album.name").alias("Album"),
        F.col("album.release_date").alias("Release Date"), F.col("popularity").cast("string").alias("Popularity"),
        F.col("explicit").cast("string").alias("Explicit"), F.col("duration_ms").cast("string").alias("Duration (ms)"),
    )


# Properties of the knowledge base and the profile columns they fill.
NAMED = {"BirthName": "P1477", "PlaceOfBirth": "P19", "CountryOfCitizenship": "P27", "VoiceType": "P412"}
LISTED = {"Genres": "P136", "Instruments": "P1303"}
BORN, ACTIVE_SINCE, IMAGE = "P569", "P2031", "P18"


def profiles_from_claims(payload: DataFrame, labels: DataFrame) -> DataFrame:
    """Flat profile of each artist: (artist, claims) and (qid, label_en) to ten attributes.

    All ids of an artist meet the labels in one join and come back as one small map.
    """
    claims = F.col("claims")
    listed = {out: F.coalesce(C.values(claims, p), F.array().cast("array<string>")) for out, p in LISTED.items()}
    ids = F.concat(
        F.array(*[C.claim_id(C.first_value(claims, p)) for p in NAMED.values()]),
        *[F.transform(v, C.claim_id) for v in listed.values()],
    )
    wanted = payload.select("artist", F.explode(F.array_distinct(ids)).alias("qid")).where("qid is not null")
    named = wanted.join(labels, "qid").groupBy("artist").agg(
        F.map_from_entries(F.collect_set(F.struct("qid", "label_en"))).alias("names")
    )
    empty = F.create_map().cast("map<string,string>")
    full = payload.join(named, "artist", "left").withColumn("names", F.coalesce("names", empty))

    def label(qid: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("names"), qid), qid)

    def one(prop: str) -> Column:
        value = C.first_value(claims, prop)
        return C.claim_string(value, F.try_element_at(F.col("names"), C.claim_id(value)))

    def many(values: Column) -> Column:
        return X.join_names(F.transform(F.filter(F.transform(values, C.claim_id), lambda q: q.isNotNull()), label))

    return full.select(
        F.col("artist").alias("Artist"),
        one(NAMED["BirthName"]).alias("BirthName"),
        C.claim_date(C.first_value(claims, BORN)).alias("DateOfBirth"),
        one(NAMED["PlaceOfBirth"]).alias("PlaceOfBirth"),
        one(NAMED["CountryOfCitizenship"]).alias("CountryOfCitizenship"),
        C.claim_date(C.first_value(claims, ACTIVE_SINCE), 4).alias("WorkPeriodStart"),
        many(listed["Genres"]).alias("Genres"),
        many(listed["Instruments"]).alias("Instruments"),
        one(NAMED["VoiceType"]).alias("VoiceType"),
        C.image_url(C.first_value(claims, IMAGE)).alias("ImageURL"),
    )


# ---- album pages ------------------------------------------------------------------------

# Fixed value: the element that holds a song title on an album page.
SONG_TITLE = r'(?s)<h3[^>]*class="(?:[^"]* )?chart_row-content-title(?: [^"]*)?"[^>]*>(.*?)</h3>'
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&amp;", "&"))


def numbered_matches(pages: DataFrame, html: str, pattern: str) -> DataFrame:
    """One row per match of the pattern's first group, numbered from 1 in page order."""
    others = [c for c in pages.columns if c != html]
    found = F.posexplode(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("pos", "raw_title")
    return pages.select(*others, found).withColumn("n", (F.col("pos") + 1).cast("bigint")).drop("pos")


def inner_text(markup: Column) -> Column:
    """Text of a markup fragment: tags out, the basic entities decoded."""
    plain = F.regexp_replace(markup, r"<[^>]*>", "")
    for entity, ch in ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(ch))
    return plain


def album_track_list(pages: DataFrame, html: str = "html") -> DataFrame:
    """(…, n, title) of each album page."""
    return numbered_matches(pages, html, SONG_TITLE).withColumn("title", X.clean_title(inner_text(F.col("raw_title")))).drop("raw_title")

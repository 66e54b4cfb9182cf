"""The canned analyses over the test tables, each with its check query."""

from __future__ import annotations

from cantora.plans import catalog
from cantora.plans import oracle_parts as O
from cantora.plans.model import Model

ARTIST, ALBUM, TRACK = "NATION_21", "Customer#000000005", "Order#5"
MOTIFS = ("reth", "thin", "shing", "onre")

QUERIES = {
    "q01": lambda m: catalog.all_artists(m),
    "q02": lambda m: catalog.artists_like(m, "tion_1"),
    "q03": lambda m: catalog.artist_genres(m),
    "q04": lambda m: catalog.albums_of_artist(m, ARTIST),
    "q05": lambda m: catalog.albums_by_popularity(m),
    "q06": lambda m: catalog.unique_words_per_album(m),
    "q07": lambda m: catalog.tracks_of_album(m, ALBUM),
    "q08": lambda m: catalog.explicit_songs_per_artist(m),
    "q09": lambda m: catalog.longest_tracks(m),
    "q10": lambda m: catalog.lyrics_of_track(m, TRACK),
    "q11": lambda m: catalog.lyrics_of_album(m, ALBUM),
    "q12": lambda m: catalog.top_by_metric(m, "line_count"),
    "q13": lambda m: catalog.top_by_metric(m, "word_count"),
    "q14": lambda m: catalog.hard_to_read(m),
    "q15": lambda m: catalog.top_by_metric(m, "lexical_density", name="name"),
    "q16": lambda m: catalog.density_per_album(m),
    "q17": lambda m: catalog.ranked_albums(m),
    "q18": lambda m: catalog.density_per_artist(m),
    "q19": lambda m: catalog.readability_per_album(m),
    "q20": lambda m: catalog.sentiment_extremes(m, highest=True),
    "q21": lambda m: catalog.sentiment_extremes(m, highest=False),
    "q22": lambda m: catalog.top_words_of_track(m, TRACK),
    "q23": lambda m: catalog.top_words_of_album(m, ARTIST, ALBUM),
    "q24": lambda m: catalog.top_words_of_artist(m, ARTIST),
    "x1_artist_compare": lambda m: catalog.compare_artists(m),
    "x2_motifs": lambda m: catalog.motifs_by_album(m, MOTIFS),
    "x3_sentiment_trend": lambda m: catalog.sentiment_by_year(m),
    "x4_explicit_trend": lambda m: catalog.explicit_share_by_year(m),
}


def queries():
    return {name: (lambda spark, sf_dir, fn=fn: fn(Model(spark, sf_dir))) for name, fn in QUERIES.items()}


READ, DENS, SENT = (f("documents", "doc_id") for f in (O.readability, O.density, O.sentiment))
METRICS = (
    f"{READ}, {DENS}, {SENT}, metrics AS (SELECT d.doc_id AS track_id, readability_score, lexical_density, sentiment_score, "
    f"{O.fill(O.WORDS, 'd.text')} AS word_count FROM documents d JOIN readability r ON d.doc_id = r.doc_id "
    "JOIN density e ON d.doc_id = e.doc_id JOIN sentiment s ON d.doc_id = s.doc_id)"
)
WITH_MODEL = f"WITH {O.MODEL}"
WITH_STAR = f"{WITH_MODEL}, {O.STAR}"
WITH_WORDS = f"{WITH_MODEL}, {O.track_words()}, {O.ALBUM_WORDS}"


def oracle_sql() -> dict[str, str]:
    artist, album, track = O.quote(ARTIST), O.quote(ALBUM), O.quote(TRACK)
    pivot = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN word = {O.quote(w)} THEN count END), 0) AS BIGINT) AS {w}" for w in MOTIFS
    )
    return {
        "q01": f"{WITH_MODEL} SELECT * FROM artists",
        "q02": f"{WITH_MODEL} SELECT * FROM artists WHERE name ILIKE '%tion_1%'",
        "q03": f"{WITH_MODEL} SELECT name, genres FROM artists",
        "q04": f"{WITH_MODEL} SELECT albums.* FROM albums JOIN artists ON artist_id = artists.id WHERE artists.name = {artist}",
        "q05": f"{WITH_MODEL} SELECT name, popularity FROM albums ORDER BY popularity DESC NULLS FIRST, id",
        "q06": f"{WITH_WORDS} SELECT a.name AS album, count(DISTINCT word) AS unique_words FROM album_words w "
               "JOIN albums a ON w.album_id = a.id GROUP BY a.name ORDER BY unique_words DESC, album",
        "q07": f"{WITH_MODEL} SELECT tracks.* FROM tracks JOIN albums ON album_id = albums.id WHERE albums.name = {album}",
        "q08": f"{WITH_MODEL} SELECT ar.name AS artist_name, count(*) AS explicit_song_count FROM tracks t "
               "JOIN albums al ON t.album_id = al.id JOIN artists ar ON al.artist_id = ar.id WHERE t.explicit GROUP BY ar.name",
        "q09": f"{WITH_MODEL} SELECT t.name AS track_name, t.duration_ms, ar.name AS artist_name, al.name AS album_name FROM tracks t "
               "JOIN albums al ON t.album_id = al.id JOIN artists ar ON al.artist_id = ar.id "
               "ORDER BY t.duration_ms DESC NULLS FIRST, t.id LIMIT 20",
        "q10": f"{WITH_MODEL} SELECT t.name AS track, d.text FROM documents d JOIN tracks t ON d.doc_id = t.id WHERE t.name = {track}",
        "q11": f"{WITH_MODEL} SELECT t.name AS track, d.text FROM documents d JOIN tracks t ON d.doc_id = t.id "
               f"JOIN albums al ON t.album_id = al.id WHERE al.name = {album} ORDER BY t.id",
        "q12": f"{WITH_MODEL} SELECT t.name AS track, {O.fill(O.LINES, 'd.text')} AS line_count FROM documents d "
               "JOIN tracks t ON d.doc_id = t.id ORDER BY line_count DESC, t.id LIMIT 10",
        "q13": f"{WITH_MODEL} SELECT t.name AS track, {O.fill(O.WORDS, 'd.text')} AS word_count FROM documents d "
               "JOIN tracks t ON d.doc_id = t.id ORDER BY word_count DESC, t.id LIMIT 10",
        "q14": f"{WITH_MODEL}, {READ} SELECT t.name, readability_score FROM readability JOIN tracks t ON doc_id = t.id "
               "WHERE readability_score < 50",
        "q15": f"{WITH_MODEL}, {DENS} SELECT t.name, lexical_density FROM density JOIN tracks t ON doc_id = t.id "
               "ORDER BY lexical_density DESC, t.id LIMIT 10",
        "q16": f"{WITH_STAR}, {DENS} SELECT artist, album, round(avg(lexical_density), 6) AS avg_lexical_density FROM star "
               "JOIN density ON track_id = doc_id GROUP BY artist, album ORDER BY avg_lexical_density DESC, artist, album LIMIT 10",
        "q17": f"""{WITH_STAR}, {METRICS}, per_album AS (SELECT artist, album, round(avg(lexical_density), 6) AS avg_lexical_density,
               round(avg(readability_score), 6) AS avg_readability_score, round(avg(sentiment_score), 6) AS avg_sentiment_score
               FROM star JOIN metrics USING (track_id) GROUP BY artist, album),
               ranked AS (SELECT *, row_number() OVER (PARTITION BY artist ORDER BY avg_lexical_density DESC, album) AS rank FROM per_album)
               SELECT * FROM ranked WHERE rank <= 10""",
        "q18": f"{WITH_STAR}, {DENS} SELECT artist, count(track_id) AS total_tracks, round(avg(lexical_density), 6) AS avg_lexical_density "
               "FROM star JOIN density ON track_id = doc_id GROUP BY artist",
        "q19": f"{WITH_STAR}, {READ} SELECT album, round(avg(readability_score), 6) AS avg_readability "
               "FROM star JOIN readability ON track_id = doc_id GROUP BY album",
        "q20": f"{WITH_STAR}, {SENT} SELECT artist, album, track, sentiment_score FROM star JOIN sentiment ON track_id = doc_id "
               "ORDER BY sentiment_score DESC NULLS FIRST, track_id LIMIT 10",
        "q21": f"{WITH_STAR}, {SENT} SELECT artist, album, track, sentiment_score FROM star JOIN sentiment ON track_id = doc_id "
               "ORDER BY sentiment_score ASC NULLS LAST, track_id LIMIT 10",
        "q22": f"{WITH_WORDS} SELECT word, count FROM track_words JOIN tracks t ON track_id = t.id WHERE t.name = {track} "
               "ORDER BY count DESC, word, track_id LIMIT 10",
        "q23": f"{WITH_WORDS} SELECT word, count FROM album_words w JOIN albums a ON w.album_id = a.id "
               f"JOIN artists ar ON a.artist_id = ar.id WHERE a.name = {album} AND ar.name = {artist} "
               "ORDER BY count DESC, word, album_id LIMIT 10",
        "q24": f"{WITH_WORDS} SELECT word, CAST(sum(count) AS BIGINT) AS total_count FROM album_words w JOIN albums a ON w.album_id = a.id "
               f"JOIN artists ar ON a.artist_id = ar.id WHERE ar.name = {artist} GROUP BY word ORDER BY total_count DESC, word LIMIT 10",
        "x1_artist_compare": f"""{WITH_STAR}, {METRICS} SELECT artist, count(track_id) AS total_tracks,
               round(avg(lexical_density), 6) AS avg_lexical_density, round(avg(readability_score), 6) AS avg_readability_score,
               round(avg(sentiment_score), 6) AS avg_sentiment_score, round(avg(word_count), 6) AS avg_word_count
               FROM star JOIN metrics USING (track_id) GROUP BY artist""",
        "x2_motifs": f"{WITH_WORDS} SELECT album_id, a.name AS album, {pivot} FROM album_words w JOIN albums a ON w.album_id = a.id "
                     f"WHERE word IN {O.in_list(MOTIFS)} GROUP BY album_id, a.name",
        "x3_sentiment_trend": f"{WITH_STAR}, {SENT} SELECT CAST(year(release_date) AS BIGINT) AS year, count(*) AS total_tracks, "
                              "round(avg(sentiment_score), 6) AS avg_sentiment FROM star JOIN sentiment ON track_id = doc_id GROUP BY 1",
        "x4_explicit_trend": f"{WITH_MODEL} SELECT CAST(year(release_date) AS BIGINT) AS year, count(*) AS total_tracks, "
                             "round(avg(CAST(explicit AS INT)), 6) AS explicit_share FROM tracks GROUP BY 1",
    }

from pyspark.sql import functions as F

from cantora import schemas
from cantora.operators import resolve
from cantora.sources import landed
from tests.landed_fixture import write_json


def test_flatten_payloads(spark, tmp_path):
    write_json(tmp_path / "artist.json", {"name": "A", "genres": ["x", "y"], "followers": {"total": 9_000_000_000}, "popularity": 5, "uri": "u"})
    row = landed.flatten_artists(landed.read_json(spark, str(tmp_path / "artist.json"), schemas.ARTIST_JSON)).first()
    assert tuple(row) == ("A", "x, y", "9000000000", "5", "u")

    write_json(tmp_path / "album.json", [{"name": "B", "images": [], "genres": []}, {"name": "C", "images": [{"url": "i1"}, {"url": "i2"}]}])
    rows = landed.flatten_albums(landed.read_json(spark, str(tmp_path / "album.json"), schemas.ALBUM_JSON)).collect()
    assert [(r.Name, r.ImageURL, r.Genres) for r in rows] == [("B", "", ""), ("C", "i1", "")]

    write_json(tmp_path / "track.json", [
        {"name": "T", "artists": [{"name": "a"}, {"name": "b"}], "album": {"name": "B", "release_date": "2000"}, "explicit": True, "duration_ms": 7}, {},
    ])
    rows = landed.flatten_tracks(landed.read_json(spark, str(tmp_path / "track.json"), schemas.TRACK_JSON)).collect()
    assert [tuple(r) for r in rows] == [("T", "a, b", "B", "2000", None, "true", "7")]


def claim(value):
    return {"mainsnak": {"datavalue": {"value": value}}}


def test_claims_to_profile(spark, tmp_path):
    claims = {
        "P1477": [claim({"text": "Robert", "language": "en"})],
        "P569": [claim({"time": "+1941-05-24T00:00:00Z"})],
        "P19": [claim({"id": "Q1"})],
        "P27": [claim({"id": "Q404"})],
        "P2031": [claim({"time": "+1959-00-00T00:00:00Z"})],
        "P136": [claim({"id": "Q3"}), claim({"id": "Q2"}), {"mainsnak": {}}, claim({"id": "Q404"})],
        "P18": [claim("Bob photo.jpg")],
    }
    write_json(tmp_path / "c.json", [{"artist": "Bob", "claims": claims}, {"artist": "None", "claims": {}}])
    payload = landed.read_json(spark, str(tmp_path / "c.json"), schemas.CLAIMS_JSON)
    labels = spark.createDataFrame([("Q1", "Duluth"), ("Q2", "folk"), ("Q3", "rock")], "qid string, label_en string")
    rows = {r.Artist: r for r in landed.profiles_from_claims(payload, labels).collect()}
    bob = rows["Bob"]
    assert (bob.BirthName, bob.DateOfBirth, bob.PlaceOfBirth, bob.CountryOfCitizenship) == ("Robert", "1941-05-24", "Duluth", "Q404")
    assert (bob.WorkPeriodStart, bob.Genres, bob.Instruments, bob.VoiceType) == ("1959", "rock, folk, Q404", "", None)
    assert bob.ImageURL.endswith("/Bob_photo.jpg")
    empty = rows["None"]
    assert (empty.BirthName, empty.DateOfBirth, empty.Genres, empty.ImageURL) == (None, "", "", "")


def test_album_track_list(spark):
    html = (
        '<h3 class="chart_row-content-title"> One <span>(Ft. X)</span>\n Lyrics</h3><h3 class="other">no</h3>'
        '<h3 id="a" class="big chart_row-content-title x">R&amp;B / Two Lyrics</h3>'
    )
    df = spark.createDataFrame([("a", html), ("b", "<p>none</p>")], "album string, html string")
    assert [tuple(r) for r in landed.album_track_list(df).orderBy("n").collect()] == [("a", 1, "One"), ("a", 2, "R&B - Two")]


def test_paged_results_dedupe_in_page_order(spark, tmp_path):
    write_json(tmp_path / "p" / "1.json", {"items": [{"id": "1", "name": "Red"}, {"id": "2", "name": "Blue"}], "next": "2"})
    write_json(tmp_path / "p" / "2.json", {"items": [{"id": "3", "name": "RED"}, {"id": "4", "name": "Green"}]})
    pages = landed.read_json(spark, str(tmp_path / "p"), schemas.PAGE_JSON).withColumn("page", landed.path_part(F.col("_metadata.file_path"), 1))
    items = resolve.page_items(pages).select("page", "pos", "item.*")
    kept = resolve.unique_names(items, [], "name", [F.col("page"), F.col("pos")])
    assert sorted(r.id for r in kept.collect()) == ["1", "2", "4"]


def test_resolve_albums(spark):
    requests = spark.createDataFrame([(1, "ABBA", "Gold"), (2, "X", "None")], "request_id int, artist string, album string")
    hits = spark.createDataFrame(
        [(1, 0, "a", "Gold Live", [("ABBA",)]), (1, 1, "b", "gold ", [("Other",)]), (1, 2, "c", " GOLD", [("Z",), ("abba",)]), (1, 3, "d", "Gold", [("ABBA",)])],
        "request_id int, pos int, id string, name string, artists array<struct<name: string>>",
    )
    assert {tuple(r)[0]: r.album_id for r in resolve.resolve_albums(requests, hits).collect()} == {1: "c", 2: None}


def test_final_and_merged_csvs_are_read_back(spark, tmp_path):
    """Cells with line breaks and quotes, numbered rows, and the first row of each artist."""
    from tests.landed_fixture import write_text

    song, lyrics = (f.name for f in (schemas.FINAL_CSV.fields[0], schemas.FINAL_CSV["Lyrics"]))
    names = schemas.FINAL_CSV.fieldNames()
    cells = [["" for _ in names] for _ in range(2)]
    for i, text in enumerate(('one\n""two""', "three")):
        cells[i][names.index(song)], cells[i][names.index(lyrics)] = f"Song {i}", f'"{text}"'
    body = "\n".join([",".join(names), *(",".join(c) for c in cells)]) + "\n"
    write_text(tmp_path / "Art" / "Alb" / "Alb_final.csv", body)
    rows = sorted(landed.read_final_albums(spark, str(tmp_path)).collect(), key=lambda r: r["row_no"])
    assert [(r["row_no"], r[song], r[lyrics]) for r in rows] == [(1, "Song 0", 'one\n"two"'), (2, "Song 1", "three")]
    assert {(r["artist_dir"], r["album_dir"]) for r in rows} == {("Art", "Alb")}

    names = schemas.MERGED_ARTIST_CSV.fieldNames()
    lines = [",".join(names), *(",".join([f"Artist {i}", *[""] * (len(names) - 1)]) for i in range(2))]
    write_text(tmp_path / "Art" / "Art_merged_metadata.csv", "\n".join(lines) + "\n")
    merged = landed.read_merged_artists(spark, str(tmp_path)).collect()
    assert [(r[names[0]], r["artist_dir"]) for r in merged] == [("Artist 0", "Art")]

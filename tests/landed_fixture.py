"""A small landed tree: two artists, albums in all states, awkward names and cells."""

import csv
import json
from pathlib import Path

TRACK_HEADER = ["Name", "Artists", "Album", "Release Date", "Popularity", "Explicit", "Duration (ms)"]
ALBUM_HEADER = ["Name", "Release Date", "Total Tracks", "Label", "Popularity", "Genres", "Album Type", "URI", "ImageURL"]
ARTIST_HEADER = ["Name", "Genres", "Followers", "Popularity", "URI"]
PROFILE_HEADER = [
    "Artist", "BirthName", "DateOfBirth", "PlaceOfBirth", "CountryOfCitizenship", "WorkPeriodStart",
    "Genres", "Instruments", "VoiceType", "ImageURL",
]


def write_csv(path: Path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def write_text(path: Path, text: str):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))


def track(name, album, popularity="50", explicit="True", duration="1000.0"):
    return [name, "A, B", album, "1999", popularity, explicit, duration]


def album(name, date, popularity="70"):
    return [name, date, "3", "L", popularity, "pop", "album", "uri:1", "http://img"]


def build(root: Path) -> dict[str, str]:
    cat, lyr, prof = root / "catalog", root / "lyrics", root / "profiles"
    ada, bo = "Ada Löw", "Bo #1+2, Co"

    write_csv(cat / ada / f"{ada}_metadata.csv", ARTIST_HEADER, [[ada, "pop", "5000000000", "abc", "u"]])
    write_csv(cat / bo / f"{bo}_metadata.csv", ARTIST_HEADER, [[bo, "", "x", "7", "u"]])
    write_csv(prof / ada / "summary.csv", PROFILE_HEADER, [[f" {ada.lower()} ", "Adele L", "1941-00-00", "Ulm", " DE ", "1990", "folk", "harp", "alto", "http://a"]])
    write_csv(prof / "Solo" / "summary.csv", PROFILE_HEADER, [["Solo", "", "1970-02-03", "", "", "", "", "", "", ""]])

    first = cat / ada / "First"
    write_csv(first / "First.csv", TRACK_HEADER, [
        track("Don't Go, \"Now\"", "First", popularity="abc", explicit="False"),
        track("Love Story", "First", duration="2000"),
        track("Silence", "First", explicit=""),
        track("Love Story", "First", duration="9999"),
        track("", "First"),
    ])
    write_csv(first / "First_album_metadata.csv", ALBUM_HEADER, [album("First", "2014-10")])
    write_csv(cat / ada / "Alive" / "Alive.csv", TRACK_HEADER, [track("Breath", "Alive")])
    write_csv(cat / ada / "Alive" / "Alive_album_metadata.csv", ALBUM_HEADER, [album("Alive", "bad")])
    write_csv(cat / ada / "Half" / "Half.csv", TRACK_HEADER, [track("Nothing", "Half")])
    second = cat / bo / "Second"
    write_csv(second / "Second.csv", TRACK_HEADER, [track("Love Story", "Second"), track("Río", "Second"), track("Empty", "Second")])
    write_csv(second / "Second_album_metadata.csv", ALBUM_HEADER, [album("Second", "1962", "")])

    write_text(lyr / ada / "First" / "Dont Go Now.txt", "x Lyrics\n\nstay with me\nI love it\n")
    write_text(lyr / ada / "First" / "Love Story (Long Version).txt", "no marker, love love story\r\nend")
    write_text(lyr / ada / "Alive" / "Breath.txt", "Breath Lyrics\nbreathe\n")
    write_text(lyr / ada / "Half" / "Nothing.txt", "Nothing Lyrics\nnone\n")
    write_text(lyr / bo / "Second" / "Love Story.txt", "hate, hate, \"terrible\" story\n")
    write_text(lyr / bo / "Second" / "Rio.txt", "agua\n")
    write_text(lyr / bo / "Second" / "Empty.txt", "")
    return {"catalog": str(cat), "lyrics": str(lyr), "profiles": str(prof), "ada": ada, "bo": bo}


def write_json(path: Path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload), encoding="utf-8")

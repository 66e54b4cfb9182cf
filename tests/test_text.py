import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from cantora.functions import claims, coerce
from cantora.functions import text as T
from tests.conftest import run_many

NAMES = ['AC/DC: "Live" ', "a<b>c", "  x|y?*\\ ", "Ångström's (Ft. X) / Ære½", "", "plain", " nb ", "Beyoncé – ﬁn"]


def test_sanitize(spark):
    bad = '<>:"/\\|?*'
    deleted = run_many(spark, T.sanitize_delete, NAMES)
    hyphens = run_many(spark, T.sanitize_hyphen, NAMES)
    for name, d, h in zip(NAMES, deleted, hyphens):
        assert d == "".join(c for c in name if c not in bad).strip()
        assert h == "".join("-" if c in bad else c for c in name).strip()


def test_slugify_matches_the_definition_and_is_idempotent(spark):
    def expected(s):
        s = unicodedata.normalize("NFKD", s.lower()).encode("ascii", "ignore").decode()
        return re.sub(r"[^a-z0-9]+", "-", re.sub(r"['\"()]", "", s)).strip("-")

    slugs = run_many(spark, lambda x: T.slugify(x), NAMES)
    assert slugs == [expected(n) for n in NAMES]
    assert run_many(spark, lambda x: T.slugify(x), slugs) == slugs


def test_fold_covers_every_code_point(spark):
    points = [chr(cp) for cp in range(0x80, sys.maxunicode + 1) if not 0xD800 <= cp <= 0xDFFF]
    texts = ["".join(points[i : i + 2000]) for i in range(0, len(points), 2000)]
    expected = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert run_many(spark, T.fold_ascii, texts) == expected
    assert run_many(spark, T.slugify, ["½ ㎏ № ™ … ① 𝐀bc ﬁ ⑩ ㏂"]) == ["12-kg-o-1-bc-fi-10-a-m"]


def test_clean_title(spark):
    cases = {
        "Song (Ft. Someone)": "Song",
        "Song Lyrics": "Song",
        "Either/Or (Ft. A) (Ft. B)": "Either-Or (Ft. A)",
        "Left Ft": "Left Ft",
        "(Ft. X)": "",
        "/": "-",
    }
    assert run_many(spark, T.clean_title, list(cases)) == list(cases.values())


def test_match_keys(spark):
    assert run_many(spark, T.title_key, ["Don't Stop!", "Ça – 99", "¿?"]) == ["dontstop", "a99", ""]
    assert run_many(spark, T.stem_key, ["Don't Stop", "A-b_C d"]) == ["don'tstop", "abcd"]
    assert run_many(spark, lambda x: T.stem_key(x, symmetric=True), ["Don't Stop"]) == ["dontstop"]


def header_oracle(text):
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    at = next((i for i, line in enumerate(lines) if "Lyrics" in line), None)
    if at is None:
        return "\n".join(lines)
    rest = lines[at + 1:]
    while rest and (not rest[0].strip() or rest[0].strip().endswith("Read More")):
        rest = rest[1:]
    return "\n".join(rest)


def test_strip_header(spark):
    texts = [
        "Song Lyrics\nfirst\nsecond\n", "3 Contributors\nSong Lyrics\n\n about … Read More\n\nfirst", "no marker\nhere",
        "a\nlast Lyrics", "Lyrics\n \nx Read More \nkept\n\nkept", "Lyrics\r\n\r\nfirst\r\nsecond\r\n", "",
        "Lyrics\n\n\n", "lyrics in lower case\nstay", "Lyrics a\nLyrics b\nc", "Lyrics\nRead More later\nx",
    ]
    got = run_many(spark, T.strip_header, texts)
    for text, result in zip(texts, got):
        assert result == header_oracle(text), text


def test_strip_sections(spark):
    assert run_many(spark, T.strip_sections, ["[Verse 1]\na\n[Chorus]\nb [x]\n"]) == ["a\nb [x]\n"]


def test_excluded_album(spark):
    names = ["Alive", "X (Deluxe)", "Deliver", "Live at Y", "Folklore"]
    assert run_many(spark, T.excluded_album, names) == [True, True, True, True, False]
    assert run_many(spark, lambda x: T.excluded_album(x, word_boundary=True), names) == [False, True, False, True, False]


def test_combine_genres(one):
    assert one(T.combine_genres, " folk ", "rock") == "folk, rock"
    assert one(T.combine_genres, None, " ") == ""
    assert one(T.combine_genres, None, "pop") == "pop"


def test_coercions(spark):
    dates = run_many(spark, lambda x: coerce.to_date_lenient(x).cast("string"), ["1962", "2014-10", "2014-10-27", "bad", "1941-00-00", "", None])
    assert dates == ["1962-01-01", "2014-10-01", "2014-10-27", None, None, None, None]
    assert run_many(spark, coerce.to_int_or_zero, ["12.0", "abc", "", "7", "5000000000", None]) == [12, 0, 0, 7, 5000000000, 0]
    assert run_many(spark, coerce.to_bool, ["True", "False", "", None, "x"]) == [True, False, None, None, None]


def test_claim_values(spark):
    values = ['{"time": "+1941-05-24T00:00:00Z"}', '{"id": "Q1"}', '{"text": "Bob"}', "plain", None, '{"time": "1941"}']
    assert run_many(spark, claims.claim_date, values) == ["1941-05-24", "", "", "", "", "1941"]
    assert run_many(spark, lambda v: claims.claim_date(v, 4), values)[0] == "1941"
    named = run_many(spark, lambda v: claims.claim_string(v, F.when(claims.claim_id(v) == "Q1", F.lit("label"))), values[1:5])
    assert named == ["label", "Bob", "plain", None]
    assert run_many(spark, claims.image_url, ["a b.jpg", None]) == [claims.IMAGE_PREFIX + "a_b.jpg", ""]

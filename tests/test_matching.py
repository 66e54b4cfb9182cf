"""Matching against brute force: substring test and difflib over all pairs of a block."""

import random
from difflib import SequenceMatcher, get_close_matches

import pytest
from pyspark.sql import functions as F

from cantora.operators import matching as MT

SCOPE = ("block",)


def brute(tracks, files):
    """{(block, title): (path, tier)} with lexicographic path order."""
    out = {}
    for block, title in {(b, t) for _, b, t in tracks}:
        if not title:
            out[block, title] = (None, "missing")
            continue
        mine = sorted((p, s) for b, p, s in files if b == block)
        hit = next((p for p, s in mine if title in s), None)
        if hit:
            out[block, title] = (hit, "contains")
            continue
        close = get_close_matches(title, [s for _, s in mine], n=1, cutoff=0.7)
        if close:
            out[block, title] = (next(p for p, s in mine if s == close[0]), "fuzzy")
        else:
            out[block, title] = (None, "missing")
    return out


def data():
    rng = random.Random(11)
    parts = ["love", "story", "blue", "moon", "ring", "a", "the", "night", "don't", "é", "99", "shine", "on", "xo"]

    def word():
        return "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))

    def garble(s):
        chars = list(s)
        for _ in range(rng.randint(0, 3)):
            if chars and rng.random() < 0.6:
                del chars[rng.randrange(len(chars))]
            else:
                chars.insert(rng.randrange(len(chars) + 1), rng.choice("abcxyz0"))
        return "".join(chars)

    files, tracks = [], []
    for block in ("p", "q", "r"):
        stems = [word() for _ in range(60)]
        files += [(block, f"{i:03d}.txt", s) for i, s in enumerate(stems)]
        titles = [garble(rng.choice(stems)) for _ in range(60)] + [word() for _ in range(20)] + ["", "z", "ab", "a", "lo"]
        tracks += [(block, t) for t in titles]
    tracks += [("empty", "nothing")]
    return [(i, b, t) for i, (b, t) in enumerate(tracks)], files


@pytest.fixture(scope="module")
def frames(spark):
    tracks, files = data()
    t = spark.createDataFrame(tracks, "id int, block string, title_key string")
    f = spark.createDataFrame(files, "block string, path string, stem_key string")
    return tracks, files, t, f


def test_match_equals_brute_force(frames):
    tracks, files, t, f = frames
    expected = brute(tracks, files)
    rows = MT.match_lyrics(t, f, SCOPE).collect()
    assert len(rows) == len(tracks)
    tiers = set()
    for r in rows:
        assert (r.match_path, r.tier) == expected[r.block, r.title_key], (r, expected[r.block, r.title_key])
        tiers.add(r.tier)
    assert tiers == {"contains", "fuzzy", "missing"}


@pytest.mark.parametrize("cutoff", [0.5, 0.7, 0.9])
def test_candidates_lose_nothing(frames, cutoff):
    _, _, t, f = frames
    titles = t.where("title_key <> ''").select("block", "title_key").distinct()
    stems = f.groupBy("block", "stem_key").agg(F.min("path").alias("path"))
    got = {(r.block, r.title_key, r.stem_key) for r in MT.fuzzy_candidates(titles, stems, SCOPE, cutoff, exact_bound=False).collect()}
    quick = {(r.block, r.title_key, r.stem_key) for r in MT.fuzzy_candidates(titles, stems, SCOPE, cutoff).collect()}
    want, want_quick = set(), set()
    all_stems = stems.collect()
    for a in titles.collect():
        for b in [s for s in all_stems if s.block == a.block]:
            m = SequenceMatcher(None, b.stem_key, a.title_key)
            if m.quick_ratio() >= cutoff:
                want_quick.add((a.block, a.title_key, b.stem_key))
            if m.ratio() >= cutoff:
                want.add((a.block, a.title_key, b.stem_key))
    assert want <= got
    assert quick == want_quick


def test_tie_goes_to_the_greater_stem(spark):
    t = spark.createDataFrame([("b", "abcdefgh")], "block string, title_key string")
    f = spark.createDataFrame([("b", "1", "abcdefgx"), ("b", "2", "abcdefgy"), ("b", "0", "zzz")], "block string, path string, stem_key string")
    r = MT.fuzzy_hits(t, f, SCOPE).first()
    assert get_close_matches("abcdefgh", ["abcdefgx", "abcdefgy", "zzz"], n=1, cutoff=0.7) == ["abcdefgy"]
    assert (r.path, r.score) == ("2", SequenceMatcher(None, "abcdefgy", "abcdefgh").ratio())


def test_one_file_serves_several_tracks_and_text_is_attached(spark):
    t = spark.createDataFrame([(1, "b", "love"), (2, "b", "story"), (3, "b", "nope")], "id int, block string, title_key string")
    f = spark.createDataFrame([("b", "p1", "lovestory", "words")], "block string, path string, stem_key string, text string")
    rows = {r.id: (r.match_path, r.Lyrics) for r in MT.attach_text(MT.match_lyrics(t, f, SCOPE), f).collect()}
    assert rows == {1: ("p1", "words"), 2: ("p1", "words"), 3: (None, "")}


def test_passages_whole_text_and_short_ones(spark):
    docs = [(1, "one two three four five six seven eight nine"), (2, "xxtwo three four five six seven eightyy"), (3, "two three"), (4, "")]
    passages = ["two three four five six seven eight", "two three", "thre", "t", "nine", "six seven eight nine ten eleven twelve", "e two th"]
    d = spark.createDataFrame(docs, "doc int, text string")
    p = spark.createDataFrame(list(enumerate(passages)), "item int, passage string")
    got = {tuple(r) for r in MT.passage_hits(d, p, "doc", "item").collect()}
    assert got == {(i, j) for i, t in docs for j, s in enumerate(passages) if s in t}


def test_no_all_pairs_plan(frames):
    _, _, t, f = frames
    plan = MT.match_lyrics(t, f, SCOPE)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("length", [199, 200, 201, 400])
def test_similarity_has_no_switch_at_any_length(spark, length):
    title = "".join(random.Random(length).choice("abc") for _ in range(length))
    pairs = [(title, title + "x"), (title, title[::-1])]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").coalesce(1).select(MT.similarity("a", "b")).collect()]
    assert got == [SequenceMatcher(None, a, b, autojunk=False).ratio() for a, b in pairs] and got[0] > 0.99

"""Lyrics-to-track matching: containment first, then fuzzy similarity, best one wins.

Titles and files meet only inside their scope (artist and album folder), and even there never as all
pairs: both sides are reduced to distinct keys and joined on parts the keys must share.

* Containment: a title of up to ``GRAM`` letters equals a substring of the file key, so the
  substrings are indexed with the first file that holds them. A longer title is anchored on the
  rarest of its ``GRAM``-letter substrings and verified.
* Fuzzy: a ratio of at least the cutoff needs a minimum number of letters in common, counted
  with multiplicity. By the prefix principle (Wang, Li and Feng, SIGMOD 2012) two such keys
  share two letters among their rarest few, so they meet on letter pairs. This loses nothing;
  the exact ratio is computed for what is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cantora.functions.text import let

GRAM = 5
CUTOFF = 0.7

# Letters from rare to frequent in English; any fixed order is right, this one is selective.
RARE_FIRST = "zqxjkvbpygfwmucldrhsnioate"


def substrings(x: Column, length: Column | int) -> Column:
    """Distinct substrings of one length."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(x) - n + 1, F.lit(1))), lambda p: F.substr(x, p, n))
    )


def _distinct_titles(tracks: DataFrame, scope: Sequence[str], title: str) -> DataFrame:
    return tracks.where(F.col(title) != "").select(*scope, F.col(title).alias("title_key")).distinct()


def _distinct_stems(files: DataFrame, scope: Sequence[str], stem: str, path: str) -> DataFrame:
    """One row per file key, with the first of its files in path order."""
    return (
        files.where(F.col(stem) != "")
        .groupBy(*scope, F.col(stem).alias("stem_key")).agg(F.min(path).alias("path"))
    )


def containment_hits(
    tracks: DataFrame, files: DataFrame, scope: Sequence[str] = ("artist_dir", "album_dir"),
    title: str = "title_key", stem: str = "stem_key", path: str = "path",
) -> DataFrame:
    """First file, in path order, whose key contains the title key: (scope, title_key, path)."""
    titles = _distinct_titles(tracks, scope, title)
    stems = _distinct_stems(files, scope, stem, path)
    length = F.char_length("title_key")

    lengths = F.sequence(F.lit(1), F.least(F.char_length("stem_key"), F.lit(GRAM)))
    every_gram = F.flatten(F.transform(lengths, lambda n: substrings(F.col("stem_key"), n)))
    first_with = (
        stems.select(*scope, "path", F.explode(every_gram).alias("title_key"))
        .groupBy(*scope, "title_key").agg(F.min("path").alias("path"))
    )
    short = titles.where(length <= GRAM).join(first_with, [*scope, "title_key"])

    postings = stems.where(F.char_length("stem_key") > GRAM).select(
        *scope, "stem_key", "path", F.explode(substrings(F.col("stem_key"), GRAM)).alias("gram")
    )
    spread = postings.groupBy(*scope, "gram").agg(F.count(F.lit(1)).alias("spread"))
    anchors = (
        titles.where(length > GRAM)
        .select(*scope, "title_key", F.explode(substrings(F.col("title_key"), GRAM)).alias("gram"))
        .join(spread, [*scope, "gram"], "left")
        .groupBy(*scope, "title_key")
        .agg(F.min(F.struct(F.coalesce("spread", F.lit(0)).alias("spread"), F.col("gram"))).alias("rarest"))
        .where("rarest.spread > 0")
        .select(*scope, "title_key", F.col("rarest.gram").alias("gram"))
    )
    long = (
        anchors.join(postings, [*scope, "gram"])
        .where(F.contains("stem_key", "title_key"))
        .groupBy(*scope, "title_key").agg(F.min("path").alias("path"))
    )
    return short.unionByName(long)


# ---- fuzzy ------------------------------------------------------------------------------


def letter_bag(x: Column) -> Column:
    """Letters of a string as distinct (letter, occurrence) tokens, rare ones first.

    The size of the intersection of two bags is the number of letters in common, counted with
    multiplicity.
    """
    rank = "".join(chr(ord("A") + i) for i in range(len(RARE_FIRST)))

    def token(letter, i, letters):
        nth = F.size(F.filter(F.slice(letters, F.lit(1), i + 1), lambda c: c == letter))
        return F.concat(F.lpad((F.lit(10000) - nth).cast("string"), 5, "0"), F.translate(letter, RARE_FIRST, rank), letter)

    letters_of = F.filter(F.split(x, ""), lambda c: c != "")
    return F.array_sort(
        let(letters_of, lambda letters: F.transform(letters, lambda c, i: token(c, i, letters)))
    )


def _subsets(tokens: Column, size: int) -> Column:
    """All ordered subsets of a token array, each as one string."""
    if size == 1:
        return tokens
    return let(
        tokens,
        lambda all_: F.flatten(
            F.transform(
                all_,
                lambda head, i: F.transform(
                    _subsets(F.slice(all_, i + 2, F.size(all_)), size - 1), lambda tail: F.concat(head, F.lit(" "), tail)
                ),
            )
        ),
    )


# Letters that a meeting key holds. More make longer key lists and fewer chance meetings.
KEY_LETTERS = 3


def meeting_keys(bag: Column, cutoff: float, letters: int = KEY_LETTERS) -> Column:
    """Keys, from its letter bag, on which a string is sure to meet all others of the cutoff.

    Two strings of n and m letters need at least ``cutoff / 2 * (n + m)`` letters in common. If
    that is ``letters`` or more, they share that many among the rare ends of their bags. Pairs
    so short that fewer letters can do meet on all subsets of that smaller size.
    """
    n = F.size(bag)
    shortest_partner = F.ceil(n * F.lit(cutoff / (2 - cutoff)) - F.lit(1e-9)).cast("int")
    needed = F.ceil((n + shortest_partner) * F.lit(cutoff / 2) - F.lit(1e-9)).cast("int")
    rare_end = n - F.greatest(needed, F.lit(letters)) + letters
    none = F.array().cast("array<string>")

    parts = [F.when(n >= letters, _subsets(F.slice(bag, F.lit(1), rare_end), letters)).otherwise(none)]
    for fewer in range(1, letters):
        parts.append(F.when(n <= F.lit(2 * fewer / cutoff - 1 + 1e-9), _subsets(bag, fewer)).otherwise(none))
    return F.concat(*parts)


SIGNATURE_WORDS = 4


def _word_bits(places: Column, k: int) -> Column:
    """The ``k``-th 64 places of a bit set as one long."""
    mine = F.filter(places, lambda p: (p >= 64 * k) & (p < 64 * (k + 1)))
    one = F.lit(1).cast("bigint")
    return F.aggregate(
        mine, F.lit(0).cast("bigint"),
        lambda acc, p: acc.bitwiseOR(F.call_function("shiftleft", one, (p - 64 * k).cast("int"))),
    )


def signature(bag: Column) -> Column:
    """Letter bag as a bit set of ``SIGNATURE_WORDS`` long words, one bit per hashed token."""
    places = F.transform(bag, lambda t: F.pmod(F.xxhash64(t), F.lit(64 * SIGNATURE_WORDS)))

    def words(found):
        named = []
        for k in range(SIGNATURE_WORDS):
            named += [F.lit(f"w{k}"), _word_bits(found, k)]
        return F.named_struct(*named)

    return let(places, words)


def _bits_only_in(a: Column, b: Column) -> Column:
    lone = [F.bit_count(a[f"w{k}"].bitwiseAND(F.bitwise_not(b[f"w{k}"]))) for k in range(SIGNATURE_WORDS)]
    return sum(lone[1:], lone[0])


def common_at_most(a: Column, size_a: Column, b: Column, size_b: Column) -> Column:
    """Upper bound of the letters in common, from two signatures.

    A bit set on one side only stands for at least one letter the other side lacks.
    """
    return F.least(size_a - _bits_only_in(a, b), size_b - _bits_only_in(b, a))


def quick_ratio(a: Column, b: Column) -> Column:
    """Upper bound of the similarity: twice the letters in common over all letters."""
    common = F.size(F.array_intersect(letter_bag(a), letter_bag(b)))
    return F.lit(2.0) * common / (F.char_length(a) + F.char_length(b))


@F.pandas_udf(DoubleType())
def similarity(first: pd.Series, second: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio at any length; the order of the arguments matters.

    The matcher's own shortcut, which from 200 letters on ignores the frequent ones, stays off.
    """
    scores = []
    matcher = SequenceMatcher(autojunk=False)
    for a, b in zip(first, second):
        if a is None or b is None:
            scores.append(None)
            continue
        matcher.set_seqs(a, b)
        scores.append(matcher.ratio())
    return pd.Series(scores, dtype="float64")


def fuzzy_candidates(
    titles: DataFrame, stems: DataFrame, scope: Sequence[str], cutoff: float = CUTOFF, exact_bound: bool = True
) -> DataFrame:
    """(scope, title_key, stem_key, path) of the pairs that can reach the cutoff.

    Signatures weed out chance meetings inside the join, before anything is shuffled again.
    ``exact_bound`` adds the quick ratio as ``bound`` and keeps only pairs that reach the cutoff
    by it.
    """

    def keyed(df, text, *more):
        # In steps: in one, bag and signature would be computed per exploded row.
        bagged = df.select(*scope, text, *more, letter_bag(F.col(text)).alias("bag"))
        signed = bagged.select("*", signature(F.col("bag")).alias(f"{text}_bits"))
        return signed.select("*", F.explode(meeting_keys(F.col("bag"), cutoff)).alias("key")).drop("bag")

    la, lb = F.char_length("title_key"), F.char_length("stem_key")
    common = common_at_most(F.col("title_key_bits"), la, F.col("stem_key_bits"), lb)
    met = (
        keyed(titles, "title_key").join(keyed(stems, "stem_key", "path"), [*scope, "key"])
        .where(F.lit(2.0) * F.least(la, lb, common) / (la + lb) >= cutoff)
        .select(*scope, "title_key", "stem_key", "path").distinct()
    )
    if not exact_bound:
        return met
    return met.withColumn("bound", quick_ratio(F.col("stem_key"), F.col("title_key"))).where(F.col("bound") >= cutoff)


def fuzzy_hits(
    tracks: DataFrame, files: DataFrame, scope: Sequence[str] = ("artist_dir", "album_dir"),
    title: str = "title_key", stem: str = "stem_key", path: str = "path", cutoff: float = CUTOFF,
) -> DataFrame:
    """Most similar file per title: (scope, title_key, path, score).

    Ties go to the greater file key, then to the first path.
    """
    titles = _distinct_titles(tracks, scope, title)
    stems = _distinct_stems(files, scope, stem, path)
    scored = fuzzy_candidates(titles, stems, scope, cutoff, exact_bound=False).withColumn(
        "score", similarity(F.col("stem_key"), F.col("title_key"))
    )
    best = (
        scored.where(F.col("score") >= cutoff)
        .groupBy(*scope, "title_key")
        .agg(F.max(F.struct("score", "stem_key", "path")).alias("best"))
    )
    return best.select(*scope, "title_key", F.col("best.path").alias("path"), F.col("best.score").alias("score"))


def match_lyrics(
    tracks: DataFrame, files: DataFrame, scope: Sequence[str] = ("artist_dir", "album_dir"),
    title: str = "title_key", stem: str = "stem_key", path: str = "path", cutoff: float = CUTOFF,
) -> DataFrame:
    """Every track with its file: the containment hit, else the most similar one, else none.

    Adds ``match_path``, ``tier`` (contains, fuzzy, missing) and ``score``. One file may serve
    several tracks.
    """
    contained = containment_hits(tracks, files, scope, title, stem, path)
    open_titles = _distinct_titles(tracks, scope, title).join(contained, [*scope, "title_key"], "left_anti")
    similar = fuzzy_hits(open_titles, files, scope, "title_key", stem, path, cutoff)
    hits = contained.select(
        *scope, "title_key", F.col("path").alias("match_path"),
        F.lit("contains").alias("tier"), F.lit(1.0).alias("score"),
    ).unionByName(
        similar.select(*scope, "title_key", F.col("path").alias("match_path"), F.lit("fuzzy").alias("tier"), "score")
    )
    hits = hits.withColumnRenamed("title_key", title)
    return tracks.join(hits, [*scope, title], "left").withColumn("tier", F.coalesce("tier", F.lit("missing")))


def attach_text(matched: DataFrame, files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Matched tracks with the text of their file; empty text where nothing matched."""
    bodies = files.select(F.col(path).alias("match_path"), F.col(text).alias("Lyrics"))
    return matched.join(bodies, "match_path", "left").withColumn("Lyrics", F.coalesce("Lyrics", F.lit("")))


# ---- whole texts ------------------------------------------------------------------------

SHINGLE = 5


def passage_hits(
    texts: DataFrame, passages: DataFrame, text_id: str, passage_id: str,
    text: str = "text", passage: str = "passage",
) -> DataFrame:
    """(text_id, passage_id) of every text that contains the passage, character by character.

    The inner words of a passage stand between white space in any text that holds it, so a run
    of ``SHINGLE`` inner words is a sure meeting point. Passages with fewer words meet on the
    first letters of their longest word. Texts are scanned whole.
    """
    items = passages.select(passage_id, passage, F.split(F.col(passage), r"\s+").alias("__w"))
    is_long = F.size("__w") >= SHINGLE + 2
    hashed = lambda words, start: F.xxhash64(F.array_join(F.slice(words, start, F.lit(SHINGLE)), " "))

    anchors = items.where(is_long).select(passage_id, hashed(F.col("__w"), F.lit(2)).alias("key"))
    docs = texts.select(text_id, F.split(F.col(text), r"\s+").alias("__w")).where(F.size("__w") >= SHINGLE)
    runs = F.transform(F.sequence(F.lit(1), F.size("__w") - SHINGLE + 1), lambda p: hashed(F.col("__w"), p))
    met = docs.select(text_id, F.explode(F.array_distinct(runs)).alias("key")).join(anchors, "key").select(text_id, passage_id)

    few = items.where(~is_long & (F.col(passage) != ""))
    if not few.isEmpty():
        longest = F.array_max(F.transform("__w", lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"]
        short_anchors = few.select(passage_id, F.substring(longest, 1, GRAM).alias("key"))
        words = texts.select(text_id, F.explode(F.array_distinct(F.split(F.col(text), r"\s+"))).alias("w"))
        lengths = F.sequence(F.lit(0), F.least(F.char_length("w"), F.lit(GRAM)))
        grams = F.flatten(F.transform(lengths, lambda n: substrings(F.col("w"), n)))
        short_met = (
            words.select(text_id, F.explode(grams).alias("key")).distinct()
            .join(short_anchors, "key").select(text_id, passage_id)
        )
        met = met.unionByName(short_met)

    return (
        met.distinct()
        .join(passages.select(passage_id, passage), passage_id)
        .join(texts.select(text_id, text), text_id)
        .where(F.contains(F.col(text), F.col(passage)))
        .select(text_id, passage_id)
    )

"""Title, file-name and lyrics string functions: Column -> Column, no UDF on the hot path."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters file systems refuse in names.
FORBIDDEN = '<>:"/\\|?*'

# White space as Unicode sees it, plus the four ASCII separators Java leaves out.
WS = r"[\s\x1c-\x1f]"
EDGE_WS = rf"(?U)^{WS}+|{WS}+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and bind it in ``body``.

    Catalyst may inline an alias into every place that uses it; a lambda variable is
    evaluated once, however often the body refers to it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(x: Column) -> Column:
    """Trim Unicode white space at both ends (SQL ``trim`` only drops spaces)."""
    return F.regexp_replace(x, EDGE_WS, "")


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def sanitize_delete(x: Column) -> Column:
    """Name usable as a file name: forbidden characters deleted."""
    return strip(F.translate(x, FORBIDDEN, ""))


def sanitize_hyphen(x: Column) -> Column:
    """Name usable as a file name: forbidden characters turned into hyphens."""
    return strip(F.translate(x, FORBIDDEN, "-" * len(FORBIDDEN)))


@lru_cache(maxsize=1)
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility fold is one ASCII character, and those where it is more, from the
    Unicode database."""
    single, several = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        folded = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode("ascii")
        if folded:
            (single if len(folded) == 1 else several)[chr(cp)] = folded
    return single, several


def fold_ascii(x: Column) -> Column:
    """Drop accents and everything else outside ASCII, as the compatibility fold of each character has it.

    Rows of plain ASCII pass, the others are translated; those with a character that folds to several
    are rebuilt in one pass over their characters.
    """
    single, several = _folds()
    one = F.translate(x, "".join(single), "".join(single.values()))
    letters, table = F.lit("".join(several)), F.split(F.lit("\x00".join(several.values())), "\x00")

    def unfold(c: Column) -> Column:
        return F.when(c.rlike(r"^\p{ASCII}$"), c).otherwise(F.coalesce(F.get(table, F.instr(letters, c) - 1), F.lit("")))

    simple = F.char_length(F.translate(one, "".join(several), "")) == F.char_length(one)
    return (
        F.when(x.rlike(r"^\p{ASCII}*$"), x)
        .when(simple, F.regexp_replace(one, r"[^\p{ASCII}]+", ""))
        .otherwise(F.array_join(F.transform(F.split(one, ""), unfold), ""))
    )


def slugify(x: Column) -> Column:
    """URL slug: lower, ASCII, quotes and round brackets dropped, other runs to one hyphen."""
    no_quotes = F.regexp_replace(fold_ascii(F.lower(x)), r"['\"()]+", "")
    return F.btrim(F.regexp_replace(no_quotes, r"[^a-z0-9]+", "-"), F.lit("-"))


def album_page_path(artist: Column, album: Column) -> Column:
    """Relative page address of an album: two slugs under ``albums``."""
    return F.concat_ws("/", F.lit("albums"), slugify(artist), slugify(album))


def clean_title(x: Column) -> Column:
    """Song title without the featuring part and the word ``Lyrics``; slashes to hyphens."""
    featured = r"\(Ft"
    head = F.when(x.rlike(featured), F.regexp_extract(x, rf"(.*){featured}", 1)).otherwise(x)
    return F.replace(strip(F.replace(head, F.lit("Lyrics"), F.lit(""))), F.lit("/"), F.lit("-"))


def title_key(x: Column) -> Column:
    """Match key of a track title: lower-case letters a-z and digits only."""
    return F.regexp_replace(F.lower(x), r"[^a-z0-9]", "")


def stem_key(x: Column, symmetric: bool = False) -> Column:
    """Match key of a lyrics file stem.

    Only spaces, hyphens and underscores go, so apostrophes and accents stay and such
    titles rely on the fuzzy tier. ``symmetric=True`` applies the title key instead.
    """
    return title_key(x) if symmetric else F.translate(F.lower(x), " -_", "")


def join_names(names: Column) -> Column:
    """Multi-valued attribute as one published string."""
    return F.array_join(names, ", ")


def combine_genres(a: Column, b: Column) -> Column:
    """Two genre strings as one; blanks and NULLs are skipped."""
    return F.concat_ws(", ", blank_to_null(a), blank_to_null(b))


def unix_newlines(x: Column) -> Column:
    return F.regexp_replace(x, r"\r\n?", "\n")


def strip_header(text: Column, marker: str = "Lyrics", leftover: str = "Read More") -> Column:
    """Lyrics without the page header.

    Everything through the first line that holds ``marker`` goes, then blank lines and
    lines ending in ``leftover``. Without a marker the text stays as it is.
    """

    def skippable(line: Column) -> Column:
        return let(strip(line), lambda s: (s == "") | F.endswith(s, F.lit(leftover)))

    def drop_leftovers(body: Column) -> Column:
        def from_first_kept(lines: Column) -> Column:
            kept = F.array_position(F.transform(lines, lambda line: ~skippable(line)), True)
            return F.when(kept == 0, F.lit("")).otherwise(
                F.array_join(F.slice(lines, kept.cast("int"), F.greatest(F.size(lines), F.lit(1))), "\n")
            )

        return let(F.split(body, "\n"), from_first_kept)

    def after_marker_line(t: Column) -> Column:
        tail = F.substr(t, F.locate(marker, t))
        return F.when(
            F.contains(tail, F.lit("\n")), F.substr(tail, F.locate("\n", tail) + F.lit(1))
        ).otherwise(F.lit(""))

    return let(
        unix_newlines(text),
        lambda t: F.when(
            F.contains(t, F.lit(marker)), drop_leftovers(after_marker_line(t))
        ).otherwise(t),
    )


def strip_sections(text: Column) -> Column:
    """Lyrics without ``[Chorus]``-style section lines."""
    return F.regexp_replace(text, r"(?m)^\[[^\]\n]*\]\n?", "")


def excluded_album(name: Column, keywords: tuple[str, ...] = ("deluxe", "live"), word_boundary: bool = False) -> Column:
    """True for album editions left out of the load.

    The default is a plain substring test, so "Alive" and "Deliver" are excluded too;
    ``word_boundary=True`` tests whole words.
    """
    low = F.lower(name)
    if word_boundary:
        return low.rlike(r"\b(?:" + "|".join(keywords) + r")\b")
    hit = F.lit(False)
    for word in keywords:
        hit = hit | F.contains(low, F.lit(word))
    return hit


def has_lyrics(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))

"""Text metrics as native column expressions.

All of them are row-local: no shuffle, no Python worker. A metric whose input is unusable is
NULL, never an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cantora.functions.text import WS, let
from cantora.functions.wordlists import FUNCTION_WORDS, STOPWORDS

VOWELS = "aeiouyàáâäèéêëìíîïòóôöùúûü"
# Any consonant letter; ``l`` apart, because consonant + "le" keeps its syllable (ta-ble).
CONSONANT = rf"[^{VOWELS}\P{{L}}]"
CONSONANT_NOT_L = rf"[^l{VOWELS}\P{{L}}]"


def words(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(text, F.lit(rf"(?U)[^\s\x1c-\x1f]+")).cast("bigint")


def lines(text: Column) -> Column:
    """Number of line feeds plus one."""
    return (
        F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    ).cast("bigint")


def chars(text: Column) -> Column:
    """Number of code points."""
    return F.char_length(text).cast("bigint")


def basic_stats(text: Column) -> Column:
    """Struct of word, line and character counts; the empty text has (0, 1, 0)."""
    safe = F.coalesce(text, F.lit(""))
    return F.struct(
        words(safe).alias("word_count"), lines(safe).alias("line_count"), chars(safe).alias("char_count")
    )


# ---- readability ------------------------------------------------------------------------

# A sentence: from a letter or digit to the closing marks.
SENTENCE = r"[\p{L}\p{N}_][^.!?]*[.!?]*"
PUNCTUATION = r"[^\p{L}\p{N}_\s\p{Z}]+"


def plain_words(text: Column) -> Column:
    """Lower-case text in which punctuation is deleted, so words are white-space runs."""
    return F.regexp_replace(F.lower(text), PUNCTUATION, "")


def syllables(plain: Column, n_words: Column) -> Column:
    """Syllables of a plain lower-case text of ``n_words`` words, by rule.

    Per word: groups of vowels, less a silent final e, at least one. Counted with three
    scans over the text in place of a loop over its words; a word without a vowel is one that
    the last scan does not find.
    """
    groups = F.regexp_count(plain, F.lit(rf"[{VOWELS}]+"))
    silent = F.regexp_count(
        plain,
        F.lit(rf"[{VOWELS}](?:l|{CONSONANT}*{CONSONANT_NOT_L})e(?![\p{{L}}\p{{N}}_])"),
    )
    with_vowel = F.regexp_count(plain, F.lit(rf"[^{VOWELS}\s\p{{Z}}]*+[{VOWELS}][^\s\p{{Z}}]*+"))
    return (groups - silent + n_words - with_vowel).cast("bigint")


def sentences(text: Column) -> Column:
    """Sentences of more than two words, at least one."""
    longer = r"(?:[^\s\p{Z}]+[\s\p{Z}]+){2}[^\s\p{Z}]"
    # A sentence that begins with three words of letters and digits keeps them: it needs no copy without marks.
    plain = r"^(?:[\p{L}\p{N}_]+[\s\p{Z}]+){2}[\p{L}\p{N}_]"
    found = F.filter(
        F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)),
        lambda s: s.rlike(plain) | F.regexp_replace(s, PUNCTUATION, "").rlike(longer),
    )
    return F.greatest(F.size(found), F.lit(1)).cast("bigint")


def flesch(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """Flesch Reading Ease (Flesch 1948)."""
    return F.when(
        n_words > 0,
        F.lit(206.835)
        - F.lit(1.015) * (n_words.cast("double") / n_sentences.cast("double"))
        - F.lit(84.6) * (n_syllables.cast("double") / n_words.cast("double")),
    )


def readability(text: Column) -> Column:
    """Reading ease of a text; NULL when it holds no word."""
    return let(
        plain_words(text),
        lambda plain: let(
            F.regexp_count(plain, F.lit(r"[^\s\p{Z}]+")),
            lambda n_words: flesch(n_words, sentences(text), syllables(plain, n_words)),
        ),
    )


# ---- lexical density --------------------------------------------------------------------

# Tokens: words with clitics split off (do|n't, she|'s), numbers, single punctuation marks,
# and runs of line breaks.
TOKEN = (
    r"\p{L}+(?=n['’]t(?!\p{L}))|n['’]t(?!\p{L})|['’](?:s|m|d|ll|re|ve)(?!\p{L})"
    r"|\p{L}+|\p{N}+|\n+|[^\p{L}\p{N}\s]"
)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def density(content: Column, total: Column) -> Column:
    return content.cast("double") / F.greatest(total, F.lit(1)).cast("double")


def lexical_density(text: Column, function_words: Sequence[str] = FUNCTION_WORDS) -> Column:
    """Content words over all tokens; 0.0 for the empty text.

    A token is a content word when it starts with a letter and is no function word. A
    part-of-speech tagger can be used instead through ``tagged_density``.
    """
    closed = list(function_words)
    return let(
        tokens(text),
        lambda toks: density(
            F.size(F.filter(toks, lambda t: t.rlike(r"^\p{L}") & ~t.isin(closed))), F.size(toks)
        ),
    )


def tagged_density(tagger_factory) -> object:
    """Lexical density through a caller's tagger, as an Arrow-batched UDF.

    ``tagger_factory()`` is called once per Python worker task and returns a function from text
    to a list of coarse part-of-speech names.
    """
    from collections.abc import Iterator

    import pandas as pd

    open_classes = {"NOUN", "VERB", "ADJ", "ADV"}

    @F.pandas_udf(DoubleType())
    def tagged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tag = tagger_factory()

        def one(text):
            try:
                tags = tag(text or "")
                return sum(t in open_classes for t in tags) / max(1, len(tags))
            except Exception:
                return None

        for batch in batches:
            yield batch.map(one).astype("float64")

    return tagged


# ---- words for the frequency tables -----------------------------------------------------

# Marks that always stand apart from a word, and colons and commas not followed by a digit.
APART = r"[«»‘’“-„`\"?!;@#$%&*()\[\]{}<>]|[-.',:](?:(?<=-)-|(?<=\.)\.+|(?<=')'|(?<=[:,])(?![0-9]))"
# Endings split off a word, and the full stop that ends a sentence.
ENDING = r"(?:n't|'(?:s|m|d|ll|re|ve)?)(?=\.?(?:\s|$))|\.(?='*(?:\s|$))"
# Contracted forms that count as two words.
FUSED_WORDS = ("cannot", "gimme", "lemme", "gonna", "wanna", "gotta")
FUSED = r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b"


def word_tokens(text: Column) -> Column:
    """Lower-case alphabetic words of a text, after the treebank way of splitting.

    Words that keep a hyphen, digit or inner apostrophe are no alphabetic tokens and drop out.
    """
    spaced = F.regexp_replace(F.lower(text), APART, " ")
    stems = F.regexp_replace(spaced, ENDING, " ")
    # Few texts hold one of the six, and looking for plain strings is far cheaper than a scan by the pattern.
    parted = let(stems, lambda s: F.when(
        reduce(or_, [F.contains(s, F.lit(w)) for w in FUSED_WORDS]), F.regexp_replace(s, FUSED, "$1$3$5$7 $2$4$6$8")).otherwise(s))
    return F.regexp_extract_all(parted, F.lit(r"(?<!\S)\p{L}+(?!\S)"), F.lit(0))


def is_stopword(word: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Set membership test; Catalyst turns the literal list into a hash set."""
    return word.isin(list(stopwords))

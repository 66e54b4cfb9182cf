"""Rule-based sentiment (Hutto & Gilbert 2014) as one native column expression.

The lexicon is a set of literals, grouped by rating: one hash-set test per distinct rating,
only for words that are in the lexicon at all. Nothing is joined, shuffled or collected.

The expression is composed as SQL text: word lists run to thousands of literals, which the
parser takes at once, where one Python call per literal would take seconds.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from cantora.functions.wordlists import BOOST, BOOSTERS_DOWN, BOOSTERS_UP, NEGATIONS, VALENCE

# Fixed values of the published rule set.
CAPS_STEP = 0.733
NEGATION_FACTOR = -0.74
NEVER_SO = (1.25, 1.5)
DISTANCE_WEIGHT = (1.0, 0.95, 0.9)
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_MAX = 0.18, 0.96
NORMALIZER = 15.0

MAX_LEXICON = 100_000


@dataclass(frozen=True)
class Rules:
    valence: dict[str, float] = field(default_factory=lambda: dict(VALENCE))
    boosters_up: tuple[str, ...] = BOOSTERS_UP
    boosters_down: tuple[str, ...] = BOOSTERS_DOWN
    negations: tuple[str, ...] = NEGATIONS

    def extended(self, valence=None, boosters_up=(), boosters_down=(), negations=()) -> Rules:
        return Rules(
            {**self.valence, **(valence or {})},
            self.boosters_up + tuple(boosters_up),
            self.boosters_down + tuple(boosters_down),
            self.negations + tuple(negations),
        )


def read_lexicon(spark, path: str) -> dict[str, float]:
    """Word ratings from a tab-separated lexicon file (word, mean, ...).

    The lexicon becomes literals of the plan, so its size is checked, not assumed.
    """
    rows = (
        spark.read.schema("word string, mean double, spread string, raw string")
        .option("sep", "\t").option("quote", "")
        .csv(path)
        .where("word is not null and mean is not null")
        .select(F.lower("word").alias("word"), "mean")
        .limit(MAX_LEXICON + 1)
        .collect()
    )
    if len(rows) > MAX_LEXICON:
        raise ValueError(f"lexicon holds more than {MAX_LEXICON} words")
    return {r.word: r.mean for r in rows}


def _let(var: str, value: str, body: str) -> str:
    """SQL text that evaluates ``value`` once and binds it to ``var`` in ``body``."""
    return f"get(transform(array({value}), {var} -> {body}), 0)"


def _in(word: str, words) -> str:
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in dict.fromkeys(words))
    return f"{word} IN ({quoted})" if quoted else "false"


# ASCII punctuation, as the characters a trim strips.
_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokens_sql(text: str) -> str:
    """White-space tokens of two or more characters, edge punctuation stripped.

    A token that is nothing but punctuation (an emoticon) stays whole.
    """
    marks = "'" + _PUNCT.replace("\\", "\\\\").replace("'", "\\'") + "'"
    bare = f"coalesce(nullif(btrim(w, {marks}), ''), w)"
    return rf"""filter(transform(split({text}, r"(?U)[\s\x1c-\x1f]+"), w -> {bare}), w -> char_length(w) > 1)"""


def rating_sql(word: str, valence: dict[str, float]) -> str:
    """Lexicon rating of a lower-case word, 0 outside the lexicon."""
    by_value: dict[float, list[str]] = defaultdict(list)
    for w, v in valence.items():
        if v:
            by_value[float(v)].append(w)
    if not by_value:
        return "0D"
    known = [w for members in by_value.values() for w in members]
    cases = " ".join(f"WHEN {_in(word, members)} THEN {v}D" for v, members in by_value.items())
    return f"CASE WHEN {_in(word, known)} THEN CASE {cases} END ELSE 0D END"


def _upper(w: str) -> str:
    return f"(upper({w}) = {w} AND lower({w}) <> {w})"


def _signed(v: str, step: str) -> str:
    """``step`` away from zero on the side of ``v``."""
    return f"(CASE WHEN {v} > 0 THEN {step} ELSE -({step}) END)"


def _token_score(rules: Rules) -> str:
    """Rating of token ``i`` after capitals, modifiers, negation and "least".

    Uses the bound names ``toks``, ``low`` (lower case), ``vals`` (ratings) and ``mixed``
    (capitals tell words apart in this text).
    """

    def at(array: str, back: int) -> str:
        return f"get({array}, i - {back})"

    def step(back: int, score: str) -> str:
        low, tok = at("low", back), at("toks", back)
        modifier = (
            f"(CASE WHEN {_in(low, rules.boosters_up)} THEN {_signed(score, f'{BOOST}D')} "
            f"WHEN {_in(low, rules.boosters_down)} THEN {_signed(score, f'-{BOOST}D')} END "
            f"+ CASE WHEN mixed AND {_upper(tok)} THEN {_signed(score, f'{CAPS_STEP}D')} ELSE 0D END)"
        )
        boosted = f"({score} + {DISTANCE_WEIGHT[back - 1]}D * coalesce({modifier}, 0D))"
        negates = f"({_in(low, rules.negations)} OR contains({low}, \"n't\"))"
        cases = f"WHEN {negates} THEN {NEGATION_FACTOR}D"
        if back == 2:
            cases = f"WHEN {low} = 'never' AND {at('low', 1)} IN ('so', 'this') THEN {NEVER_SO[1]}D " + cases
        elif back == 3:
            emphatic = f"{at('low', 2)} IN ('so', 'this') OR {at('low', 1)} IN ('so', 'this')"
            cases = f"WHEN {low} = 'never' AND ({emphatic}) THEN {NEVER_SO[0]}D " + cases
        # A neighbour counts when it exists and is no rated word itself.
        applies = f"i >= {back} AND {at('vals', back)} = 0D"
        return f"CASE WHEN {applies} THEN {boosted} * CASE {cases} ELSE 1D END ELSE {score} END"

    own = "get(vals, i)"
    start = f"{own} + CASE WHEN mixed AND {_upper('get(toks, i)')} THEN {_signed(own, f'{CAPS_STEP}D')} ELSE 0D END"
    least = (
        f"i >= 1 AND {at('low', 1)} = 'least' AND {at('vals', 1)} = 0D "
        f"AND NOT coalesce({at('low', 2)} IN ('at', 'very'), false)"
    )
    last = f"CASE WHEN {least} THEN s3 * {NEGATION_FACTOR}D ELSE s3 END"
    scored = _let("s0", start, _let("s1", step(1, "s0"), _let("s2", step(2, "s1"), _let("s3", step(3, "s2"), last))))
    return f"CASE WHEN {_in('get(low, i)', rules.boosters_up + rules.boosters_down)} THEN 0D ELSE {scored} END"


def _sum_sql(text: str, rules: Rules) -> str:
    """Sum of the token scores in token order, with the shift around the first "but"."""
    weight = (
        f"CASE WHEN but = 0 OR i = but - 1 THEN 1D WHEN i < but - 1 THEN {BUT_BEFORE}D ELSE {BUT_AFTER}D END"
    )
    part = f"CASE WHEN get(vals, i) = 0D THEN acc ELSE acc + ({_token_score(rules)}) * {weight} END"
    folded = f"aggregate(sequence(0, size(toks) - 1), 0D, (acc, i) -> {part})"
    n_upper = f"size(filter(toks, w -> {_upper('w')}))"
    bound = _let(
        "mixed", _let("n", n_upper, "n > 0 AND n < size(toks)"), _let("but", "array_position(low, 'but')", folded)
    )
    rated = f"CASE WHEN exists(vals, v -> v <> 0D) THEN {bound} ELSE 0D END"
    return _let(
        "toks", tokens_sql(text),
        _let("low", "transform(toks, w -> lower(w))",
             _let("vals", f"transform(low, w -> {rating_sql('w', rules.valence)})", rated)),
    )


def _marks_sql(text: str) -> str:
    """Emphasis of exclamation and question marks."""

    def count(mark: str) -> str:
        return f"(char_length({text}) - char_length(replace({text}, '{mark}', '')))"

    ask = (
        f"CASE WHEN {count('?')} <= 1 THEN 0D WHEN {count('?')} <= 3 THEN {count('?')} * {QUESTION_STEP}D "
        f"ELSE {QUESTION_MAX}D END"
    )
    return f"(least({count('!')}, {EXCLAMATION_MAX}) * {EXCLAMATION_STEP}D + {ask})"


def compound(text: str, rules: Rules | None = None, total: str | None = None) -> Column:
    """Compound sentiment in [-1, 1], four digits; 0.0 for a text without rated words.

    ``text`` is a column name or SQL expression; NULL counts as the empty text. ``total`` is the sum of
    the token scores where it is known already.
    """
    emphasized = (
        f"CASE WHEN total > 0 THEN total + {_marks_sql('body')} "
        f"WHEN total < 0 THEN total - {_marks_sql('body')} ELSE total END"
    )
    squashed = f"round(greatest(-1D, least(1D, x / sqrt(x * x + {NORMALIZER}D))), 4)"
    return F.expr(
        _let("body", f"coalesce({text}, '')",
             _let("total", total or _sum_sql("body", rules or Rules()), _let("x", emphasized, squashed)))
    )

"""Building blocks of the check queries (DuckDB SQL) for the model and the text metrics."""

from __future__ import annotations

from cantora.functions import wordlists as W
from cantora.functions.metrics import CONSONANT, CONSONANT_NOT_L, SENTENCE, VOWELS
from cantora.plans.model import STANDIN_RULES


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(quote(w) for w in dict.fromkeys(words)) + ")"


def fill(template: str, text: str) -> str:
    """Put a text expression into a template at {t}; other braces belong to patterns."""
    return template.replace("{t}", text)


ARTISTS = """artists AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS genres
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
ALBUMS = """albums AS (SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS artist_id,
  CAST(floor(c_acctbal) AS BIGINT) AS popularity FROM customer)"""
TRACKS = """tracks AS (SELECT o_orderkey AS id, 'Order#' || CAST(o_orderkey AS VARCHAR) AS name,
  o_custkey AS album_id, CAST(floor(o_totalprice) AS BIGINT) AS duration_ms, o_orderstatus = 'F' AS explicit,
  CAST(o_orderdate AS DATE) AS release_date FROM orders)"""
MODEL = f"{ARTISTS}, {ALBUMS}, {TRACKS}"

WORDS = r"CAST(len(regexp_extract_all({t}, '\S+')) AS BIGINT)"
LINES = "CAST(length({t}) - length(replace({t}, chr(10), '')) + 1 AS BIGINT)"
CHARS = "CAST(length({t}) AS BIGINT)"

# -- readability: word by word, where the library scans the text ---------------------------
_PUNCT = r"[^\p{L}\p{N}_\s\p{Z}]+"
_PLAIN_WORDS = (
    "list_filter(regexp_split_to_array(regexp_replace(lower({t}), "
    + quote(_PUNCT) + r", '', 'g'), '[\s\p{Z}]+'), lambda w: w <> '')"
)
_SYLLABLES = (
    "greatest(1, len(regexp_extract_all(w, " + quote(f"[{VOWELS}]+") + ")) - CASE WHEN regexp_matches(w, "
    + quote(f"[{VOWELS}](l|{CONSONANT}*{CONSONANT_NOT_L})e$") + ") THEN 1 ELSE 0 END)"
)
_SENTENCES = (
    "greatest(1, len(list_filter(regexp_extract_all({t}, " + quote(SENTENCE) + "), lambda s: regexp_matches("
    "regexp_replace(s, " + quote(_PUNCT) + r", '', 'g'), '([^\s\p{Z}]+[\s\p{Z}]+){2}[^\s\p{Z}]'))))"
)


def readability(source: str, key: str, text: str = "text", name: str = "readability") -> str:
    return f"""{name}_counts AS (SELECT {key}, {fill(_PLAIN_WORDS, text)} AS ws,
    CAST({fill(_SENTENCES, text)} AS DOUBLE) AS n_sentences FROM {source}),
{name} AS (SELECT {key}, CASE WHEN len(ws) > 0 THEN CAST(206.835 AS DOUBLE)
    - CAST(1.015 AS DOUBLE) * (CAST(len(ws) AS DOUBLE) / n_sentences)
    - CAST(84.6 AS DOUBLE) * (CAST(list_sum(list_transform(ws, lambda w: {_SYLLABLES})) AS DOUBLE) / CAST(len(ws) AS DOUBLE))
    END AS readability_score FROM {name}_counts)"""


# -- lexical density: clitics are marked first, RE2 having no look-ahead --------------------
_MARKED = (
    r"regexp_replace(regexp_replace(lower({t}), 'n([''’])t($|[^\p{L}])', ' N\1T\2', 'g'), "
    r"'([''’])(s|m|d|ll|re|ve)($|[^\p{L}])', ' ⟨\2\3', 'g')"
)
_TOKENS = "regexp_extract_all(" + _MARKED + r", 'N[''’]T|⟨[a-z]+|\p{L}+|\p{N}+|\n+|[^\p{L}\p{N}\s]')"


def density(source: str, key: str, text: str = "text", name: str = "density") -> str:
    return f"""{name}_tokens AS (SELECT {key}, {fill(_TOKENS, text)} AS toks FROM {source}),
{name} AS (SELECT {key}, CAST(len(list_filter(toks, lambda t: regexp_matches(t, '^\\p{{L}}')
    AND NOT regexp_matches(t, '^N.T$') AND t NOT IN {in_list(W.FUNCTION_WORDS)})) AS DOUBLE)
    / CAST(greatest(len(toks), 1) AS DOUBLE) AS lexical_density FROM {name}_tokens)"""


# -- words for the frequency tables ---------------------------------------------------------
_WORD_STEPS = (
    (r"[«»“”„‘’`\"?!;@#$%&*()\[\]{}<>]|--|\.\.+|''", " "),
    (r"[:,]([^0-9]|$)", r" \1"),
    (r"[:,]([^0-9]|$)", r" \1"),
    (r"\.('*)(\s|$)", r" \1\2"),
    (r"(n't|'(s|m|d|ll|re|ve)?)(\s|$)", r" \3"),
    (r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b", r"\1\3\5\7 \2\4\6\8"),
)


def word_list(text: str) -> str:
    expr = f"lower({text})"
    for pattern, repl in _WORD_STEPS:
        expr = f"regexp_replace({expr}, {quote(pattern)}, {quote(repl)}, 'g')"
    return (
        f"list_filter(regexp_split_to_array({expr}, '\\s+'), lambda w: regexp_full_match(w, '\\p{{L}}+') "
        f"AND w NOT IN {in_list(W.STOPWORDS)})"
    )


def track_words(source: str = "documents", key: str = "doc_id") -> str:
    return f"""track_words AS (SELECT track_id, word, count(*) AS count FROM
    (SELECT {key} AS track_id, unnest({word_list('text')}) AS word FROM {source}) GROUP BY track_id, word)"""


ALBUM_WORDS = """album_words AS (SELECT album_id, word, CAST(sum(count) AS BIGINT) AS count
    FROM track_words JOIN tracks ON track_id = tracks.id GROUP BY album_id, word)"""


# -- sentiment: one row per token, neighbours through lag ------------------------------------
def sentiment(source: str, key: str, text: str = "text", rules=STANDIN_RULES, name: str = "sentiment") -> str:
    punct = r"[!-/:-@\[-`{-~]+"
    strip = f"regexp_replace(w, {quote(f'^{punct}|{punct}$')}, '', 'g')"
    by_value: dict[float, list[str]] = {}
    for word, v in rules.valence.items():
        by_value.setdefault(v, []).append(word)
    rating = "CASE " + " ".join(
        f"WHEN low IN {in_list(ws)} THEN CAST({v} AS DOUBLE)" for v, ws in by_value.items()
    ) + " ELSE CAST(0 AS DOUBLE) END"
    up, down = in_list(rules.boosters_up), in_list(rules.boosters_down)
    neg = in_list(rules.negations)
    modifier = in_list(rules.boosters_up + rules.boosters_down)
    weights = {1: "1.0", 2: "0.95", 3: "0.9"}

    def step(i: int, prev: str) -> str:
        sgn = f"(CASE WHEN {prev} > 0 THEN 1.0 ELSE -1.0 END)"
        boost = (
            f"(CASE WHEN l{i} IN {up} THEN CAST({sgn} * 0.293 AS DOUBLE) WHEN l{i} IN {down} THEN CAST({sgn} * -0.293 AS DOUBLE) END"
            f" + CASE WHEN mixed AND upper(t{i}) = t{i} AND lower(t{i}) <> t{i} THEN CAST({sgn} * 0.733 AS DOUBLE) ELSE 0.0 END)"
        )
        boosted = f"({prev} + CAST({weights[i]} AS DOUBLE) * coalesce({boost}, CAST(0 AS DOUBLE)))"
        negated = f"(l{i} IN {neg} OR contains(l{i}, 'n''t'))"
        if i == 1:
            factor = f"CASE WHEN {negated} THEN -0.74 ELSE 1.0 END"
        elif i == 2:
            factor = f"CASE WHEN l2 = 'never' AND l1 IN ('so', 'this') THEN 1.5 WHEN {negated} THEN -0.74 ELSE 1.0 END"
        else:
            factor = (
                "CASE WHEN l3 = 'never' AND (l2 IN ('so', 'this') OR l1 IN ('so', 'this')) THEN 1.25 "
                f"WHEN {negated} THEN -0.74 ELSE 1.0 END"
            )
        return f"CASE WHEN l{i} IS NOT NULL AND v{i} = 0 THEN {boosted} * CAST({factor} AS DOUBLE) ELSE {prev} END"

    lags = ", ".join(
        f"lag(tok, {i}) OVER o AS t{i}, lag(low, {i}) OVER o AS l{i}, lag(v, {i}) OVER o AS v{i}" for i in (1, 2, 3)
    )
    return f"""{name}_t AS (SELECT {key}, {text} AS body, list_filter(list_transform(
        list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: length(w) > 1),
        lambda w: CASE WHEN {strip} = '' THEN w ELSE {strip} END), lambda w: length(w) > 1) AS toks FROM {source}),
{name}_u AS (SELECT {key}, unnest(toks) AS tok, unnest(generate_series(1, len(toks))) AS pos, n_upper, n FROM
        (SELECT {key}, toks, len(list_filter(toks, lambda t: upper(t) = t AND lower(t) <> t)) AS n_upper, len(toks) AS n FROM {name}_t)),
{name}_v AS (SELECT *, lower(tok) AS low, n_upper > 0 AND n_upper < n AS mixed FROM {name}_u),
{name}_r AS (SELECT *, {rating} AS v FROM {name}_v),
{name}_l AS (SELECT *, min(CASE WHEN low = 'but' THEN pos END) OVER (PARTITION BY {key}) AS but_pos, {lags}
        FROM {name}_r WINDOW o AS (PARTITION BY {key} ORDER BY pos)),
{name}_0 AS (SELECT *, v + CASE WHEN mixed AND upper(tok) = tok AND lower(tok) <> tok
        THEN CASE WHEN v > 0 THEN CAST(0.733 AS DOUBLE) ELSE CAST(-0.733 AS DOUBLE) END ELSE CAST(0 AS DOUBLE) END AS s0
        FROM {name}_l WHERE v <> 0 AND low NOT IN {modifier}),
{name}_1 AS (SELECT *, {step(1, 's0')} AS s1 FROM {name}_0),
{name}_2 AS (SELECT *, {step(2, 's1')} AS s2 FROM {name}_1),
{name}_3 AS (SELECT *, {step(3, 's2')} AS s3 FROM {name}_2),
{name}_4 AS (SELECT {key}, pos, (CASE WHEN l1 = 'least' AND v1 = 0 AND NOT coalesce(l2 IN ('at', 'very'), false)
        THEN s3 * CAST(-0.74 AS DOUBLE) ELSE s3 END) * CASE WHEN but_pos IS NULL OR pos = but_pos THEN CAST(1 AS DOUBLE)
        WHEN pos < but_pos THEN CAST(0.5 AS DOUBLE) ELSE CAST(1.5 AS DOUBLE) END AS s FROM {name}_3),
{name}_s AS (SELECT {key}, list_reduce(list_prepend(CAST(0 AS DOUBLE), list(s ORDER BY pos)), lambda a, b: a + b) AS total
        FROM {name}_4 GROUP BY {key}),
{name}_p AS (SELECT {key}, least(length(body) - length(replace(body, '!', '')), 4) * CAST(0.292 AS DOUBLE)
        + CASE WHEN length(body) - length(replace(body, '?', '')) <= 1 THEN CAST(0 AS DOUBLE)
          WHEN length(body) - length(replace(body, '?', '')) <= 3
          THEN (length(body) - length(replace(body, '?', ''))) * CAST(0.18 AS DOUBLE) ELSE CAST(0.96 AS DOUBLE) END AS marks FROM {name}_t),
{name}_x AS (SELECT p.{key}, coalesce(CASE WHEN total > 0 THEN total + marks WHEN total < 0 THEN total - marks ELSE total END,
        CAST(0 AS DOUBLE)) AS x FROM {name}_p p LEFT JOIN {name}_s s ON p.{key} = s.{key}),
{name} AS (SELECT {key}, round(greatest(-1.0, least(1.0, x / sqrt(x * x + CAST(15 AS DOUBLE)))), 4) AS sentiment_score FROM {name}_x)"""


STAR = """star AS (SELECT d.doc_id AS track_id, t.name AS track, a.name AS album, ar.name AS artist, t.explicit, t.release_date
  FROM documents d JOIN tracks t ON d.doc_id = t.id JOIN albums a ON t.album_id = a.id JOIN artists ar ON a.artist_id = ar.id)"""

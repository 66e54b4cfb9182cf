"""Metrics against independent plain-Python versions on edge texts."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cantora.functions import metrics as M
from cantora.functions import sentiment as S
from cantora.functions.wordlists import NEGATIONS, STOPWORDS
from tests.conftest import run_many

TEXTS = [
    "", "   ", "...!!!", "one", "I'm gonna love you, well-known baby. Don't stop!\nCafé d'été\n", "The table is whole. A cute apple.",
    "It was the best of times; it was the worst of times: 12,000 1:30 a,b", "HELLO world again", "rhythm hmm psst",
    "cannot wanna gimme lemme gotta 'tis", "No. Yes. I am here now, truly. Ok?", "dogs' she's they've we'll he'd I'm you're ain't shouldn't've",
    "abc123 x_y naïve coöperate", "line one\nline two\n\nline four", "wait... what?! (really) [Chorus] {x} <y>", "a",
]


def test_basic_stats(spark):
    for t, s in zip(TEXTS, run_many(spark, M.basic_stats, TEXTS)):
        assert tuple(s) == (len(t.split()), t.count("\n") + 1, len(t)), t


def python_flesch(text):
    plain = re.sub(r"[^\w\s]", "", text.lower())
    words = plain.split()
    if not words:
        return None
    vowels = set(M.VOWELS)

    def syllables(w):
        groups = len(re.findall(f"[{M.VOWELS}]+", w))
        letters = [c for c in w]
        silent = (
            len(w) > 2 and letters[-1] == "e" and letters[-2].isalpha() and letters[-2] not in vowels
            and groups > 1 and not (letters[-2] == "l" and letters[-3] not in vowels)
        )
        # The run of consonants before the e has to follow a vowel directly.
        if silent:
            run = re.search(rf"[{M.VOWELS}]([^{M.VOWELS}\W\d_]+)e$", w)
            silent = bool(run)
        return max(1, groups - silent)

    found = re.findall(r"\w[^.!?]*[.!?]*", text)
    sentences = max(1, sum(len(re.sub(r"[^\w\s]", "", s).split()) > 2 for s in found))
    return 206.835 - 1.015 * len(words) / sentences - 84.6 * sum(map(syllables, words)) / len(words)


def test_readability(spark):
    for t, score in zip(TEXTS, run_many(spark, M.readability, TEXTS)):
        expected = python_flesch(t)
        assert (score is None) == (expected is None), t
        if expected is not None:
            assert score == pytest.approx(expected, abs=1e-9), t


def test_lexical_density_bounds_and_cases(spark):
    got = dict(zip(TEXTS, run_many(spark, M.lexical_density, TEXTS)))
    assert got[""] == 0.0 and got["...!!!"] == 0.0
    # A number word is no content word, a noun is.
    assert got["one"] == 0.0 and run_many(spark, M.lexical_density, ["river"]) == [1.0]
    assert all(0.0 <= v <= 1.0 for v in got.values())
    # the table is whole . a cute apple .  -> table, whole, cute, apple of 9 tokens
    assert got["The table is whole. A cute apple."] == pytest.approx(4 / 9)


def test_word_tokens(spark):
    cases = {
        "I'm gonna love you, well-known baby. Don't stop!": ["i", "gon", "na", "love", "you", "baby", "do", "stop"],
        "cannot wanna gimme lemme gotta": ["can", "not", "wan", "na", "gim", "me", "lem", "me", "got", "ta"],
        "Café d'été x1 1,000 a,b 3:30 e.g. end.": ["café", "a", "b", "end"],
        "dogs' she's “quoted” don’t": ["dogs", "she", "quoted", "don", "t"],
        "(paren) [x] --dash-- wait... what?": ["paren", "x", "dash", "wait", "what"],
        "": [],
    }
    got = run_many(spark, M.word_tokens, list(cases))
    for (text, expected), words in zip(cases.items(), got):
        assert words == expected, text


def test_track_words_drop_stopwords(spark):
    from cantora.operators.wordfreq import track_words

    df = spark.createDataFrame([(1, "Love love the LOVE of and"), (2, None), (3, "")], "track_id bigint, text string")
    assert {tuple(r) for r in track_words(df).collect()} == {(1, "love", 3)}
    assert "the" in STOPWORDS


# ---- sentiment against a plain-Python version of the rules ---------------------------------


def python_compound(text, rules):
    punct = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

    def strip(w):
        s = w.strip(punct)
        return s or w

    toks = [strip(w) for w in text.split() if len(w) > 1]
    toks = [w for w in toks if len(w) > 1]
    low = [w.lower() for w in toks]
    upper = [w.isupper() for w in toks]
    mixed = 0 < sum(upper) < len(toks)
    val = [rules.valence.get(w, 0.0) for w in low]

    def negated(w):
        return w in rules.negations or "n't" in w

    def boost(j, v):
        if low[j] in rules.boosters_up:
            b = 0.293
        elif low[j] in rules.boosters_down:
            b = -0.293
        else:
            return 0.0
        b = b if v > 0 else -b
        if upper[j] and mixed:
            b += 0.733 if v > 0 else -0.733
        return b

    scores = []
    for i, v in enumerate(val):
        if v == 0 or low[i] in rules.boosters_up + rules.boosters_down:
            scores.append(0.0)
            continue
        s = v + ((0.733 if v > 0 else -0.733) if upper[i] and mixed else 0.0)
        for back, weight in ((1, 1.0), (2, 0.95), (3, 0.9)):
            j = i - back
            if j < 0 or val[j] != 0:
                continue
            s += weight * boost(j, s)
            if back == 2 and low[j] == "never" and low[i - 1] in ("so", "this"):
                s *= 1.5
            elif back == 3 and low[j] == "never" and (low[i - 2] in ("so", "this") or low[i - 1] in ("so", "this")):
                s *= 1.25
            elif negated(low[j]):
                s *= -0.74
        if i >= 1 and low[i - 1] == "least" and val[i - 1] == 0 and not (i >= 2 and low[i - 2] in ("at", "very")):
            s *= -0.74
        scores.append(s)
    if "but" in low:
        b = low.index("but")
        scores = [s * (0.5 if i < b else 1.5 if i > b else 1.0) for i, s in enumerate(scores)]
    total = sum(scores)
    marks = min(text.count("!"), 4) * 0.292
    q = text.count("?")
    marks += 0 if q <= 1 else q * 0.18 if q <= 3 else 0.96
    total += marks if total > 0 else -marks if total < 0 else 0
    return round(total / math.sqrt(total * total + 15), 4)


def test_sentiment_rules(spark):
    rules = S.Rules()
    texts = [
        "", "good", "not good", "very good", "I don't really love it", "never so good", "I never this much love", "at least good",
        "the least good", "good but bad", "It is GOOD!!!", "GOOD BAD", "bad?? why???", "good!!!!!!! ok?", "slightly happy but VERY sad",
        "without love", "love. 'hate', (joy)", "!!! ??", "VERY good day", "kinda good, barely bad", "so so so happy", None,
    ]
    rng = random.Random(5)
    vocab = ["good", "bad", "LOVE", "very", "SLIGHTLY", "not", "never", "so", "this", "least", "at", "but", "song", "the", "hate!", "joy?", "isn't"]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    got = run_many(spark, lambda x: S.compound("x", rules), texts)
    for t, score in zip(texts, got):
        assert score == pytest.approx(python_compound(t or "", rules), abs=1.01e-4), t
        assert -1.0 <= score <= 1.0
    assert "don't" in NEGATIONS


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text("zig\t2.5\t0.5\t[1]\n:)\t2.0\t0.4\t[2]\nzag'z\t-1.5\t0.3\t[3]\n")
    rules = S.Rules(S.read_lexicon(spark, str(path)))
    assert rules.valence == {"zig": 2.5, ":)": 2.0, "zag'z": -1.5}
    got = run_many(spark, lambda x: S.compound("x", rules), ["zig", ":)", "zag'z", "good"])
    assert got[0] > 0 and got[1] > 0 and got[2] < 0 and got[3] == 0.0


def test_fused_words_are_parted_and_looked_for_by_plain_search(spark):
    texts = ["I CANNOT go", "gimme gonna gotta lemme wanna", "cannots scannot", "ice--cold a-b c..d ''x'' 1,2 a,b 3:4 a: “q”„r‘s’", "plain words"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = rows.select("i", M.word_tokens(F.col("text")).alias("w"))
    assert [r["w"] for r in found.orderBy("i").collect()] == [
        ["i", "can", "not", "go"], ["gim", "me", "gon", "na", "got", "ta", "lem", "me", "wan", "na"], ["cannots", "scannot"],
        ["ice", "cold", "c", "d", "x", "a", "b", "a", "q", "r", "s"], ["plain", "words"],
    ]
    assert "contains" in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_sentences_that_begin_with_three_words_need_no_copy(spark):
    texts = ["One two three. Four five", "a, b c. - d e", "a - b. it's so here! x y? 1 2 3", "a .b c d", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = rows.select("i", M.sentences(F.col("text")).alias("n"))
    assert [r["n"] for r in found.orderBy("i").collect()] == [1, 1, 2, 1, 1]
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("rlike") == 2

"""Metrics and words of many texts at once, over arrays of their characters.

The column expressions of ``metrics`` and ``sentiment`` stay the definition, and tests hold these functions to
them. A text with a character that has no fixed class or case (unassigned in Unicode 3.2 or changed since, lower
case that depends on its neighbours, outside the basic plane) gets NULL here and is left to the expressions.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from cantora.functions import metrics, sentiment
from cantora.functions.wordlists import FUNCTION_WORDS

END = "\0"  # follows every text of a chunk
CHUNK_CHARS = CHUNK_WORDS = 1 << 18

LETTER, DIGIT, BLANK, WHITE, KEPT, VOWEL, STOP, APART, PUNCT, HAS_UPPER, HAS_LOWER, PLAIN = (1 << i for i in range(12))
_JAVA_BLANKS = " \t\n\x0b\f\r"
_APART = "«»‘’“-„`\"?!;@#$%&*()[]{}<>"
_APART_CHARS = {c for c in _APART if c != "-"} | {chr(c) for c in range(ord("“"), ord("„") + 1)}


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Flags and lower case of every character of the basic plane."""
    flags, low = np.zeros(1 << 16, np.uint16), np.arange(1 << 16, dtype=np.uint16)
    old = unicodedata.ucd_3_2_0

    def classes(c: str) -> int:
        kind = unicodedata.category(c)[0]
        blank = c in _JAVA_BLANKS
        return (
            LETTER * (kind == "L") | DIGIT * (kind == "N") | BLANK * blank
            | WHITE * (kind == "Z" or "\t" <= c <= "\r" or "\x1c" <= c <= "\x1f" or c == "\x85")
            | KEPT * (kind in "LNZ" or c == "_" or blank)
        )

    for i in range(1, 1 << 16):
        c = chr(i)
        kind, lower = unicodedata.category(c), c.lower()
        if kind in ("Cs", "Cn", "Co") or len(lower) != 1 or ord(lower) >> 16:
            continue
        flag = classes(c)
        fixed = kind == old.category(c) and flag == classes(lower) and c not in "\u03a3\x85\u2028\u2029"
        flags[i] = (
            flag | PLAIN * fixed | VOWEL * (lower in metrics.VOWELS) | STOP * (c in ".!?") | APART * (c in _APART_CHARS)
            | PUNCT * (c in sentiment._PUNCT) | HAS_UPPER * (c.upper() != c) | HAS_LOWER * (lower != c)
        )
        low[i] = ord(lower)
    flags[0] = BLANK | WHITE | KEPT | STOP | PLAIN
    return flags, low


def _after(flag: np.ndarray, first: bool) -> np.ndarray:
    """The value before each place."""
    return np.concatenate(([first], flag[:-1]))


def _starts(flag: np.ndarray) -> np.ndarray:
    """Places where a run of true values begins."""
    return np.flatnonzero(flag & ~_after(flag, False))


class Chunk:
    """Texts side by side, with the flags and the lower case of their characters."""

    def __init__(self, texts: list[str]):
        flags, low = _tables()
        joined = END.join(texts) + END
        self.odd = np.zeros(len(texts), bool)
        if joined.count(END) != len(texts):
            joined = self._without([END in t for t in texts], texts)
        units = self._units(joined)
        odd = np.flatnonzero((flags[units] & PLAIN) == 0)
        if len(odd):
            places = np.unique(np.searchsorted(np.flatnonzero(units == 0), odd))
            bad = np.zeros(len(texts), bool)
            bad[places] = True
            units = self._units(self._without(bad, texts))
        self.units, self.flags, self.low = units, flags[units], low[units]
        if units.dtype == np.uint8:
            self.low = self.low.astype(np.uint8)
        self.ends = np.flatnonzero(units == 0)
        self.begins = np.concatenate(([0], self.ends[:-1] + 1))

    def _without(self, bad, texts: list[str]) -> str:
        self.odd |= np.asarray(bad)
        return END.join("" if x else t for t, x in zip(texts, self.odd)) + END

    @staticmethod
    def _units(joined: str) -> np.ndarray:
        if joined.isascii():
            return np.frombuffer(joined.encode("ascii"), np.uint8)
        return np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)

    def has(self, flag: int) -> np.ndarray:
        return (self.flags & flag) != 0

    def per_text(self, places: np.ndarray) -> np.ndarray:
        return _counts(places, self.ends)

    def runs(self, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The runs of the marked places, in lower case, and where they begin."""
        starts, places = _starts(inside), np.flatnonzero(inside)
        return self.strings(places, np.searchsorted(places, starts)), starts

    def strings(self, places: np.ndarray, firsts: np.ndarray) -> pa.Array:
        """Characters at ``places`` in lower case as strings, each of which begins at one of ``firsts``."""
        chars = self.low[places]
        if chars.dtype == np.uint8:
            data, at = chars.tobytes(), np.append(firsts, len(chars))
        else:
            data = chars.tobytes().decode("utf-16-le").encode()
            size = np.concatenate(([0], np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800))))
            at = size[np.append(firsts, len(chars))]
        return pa.StringArray.from_buffers(len(firsts), pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data))


def _counts(places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the sorted places lie before each end and not before the end in front of it."""
    return np.diff(np.searchsorted(places, ends), prepend=0)


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """The texts in order, about as many at a time as the processor's cache holds."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py())
        size += len(some[-1])
        if size >= CHUNK_CHARS:
            yield Chunk(some)
            some, size = [], 0
    if some:
        yield Chunk(some)


def _in(words: pa.Array, values) -> np.ndarray:
    found = pc.is_in(words, value_set=pa.array(list(values), pa.string()))
    return np.asarray(found.to_numpy(zero_copy_only=False), bool)


# ---- metrics ----------------------------------------------------------------------------


def basic(c: Chunk) -> dict[str, np.ndarray]:
    """Words, lines and characters, as ``metrics.basic_stats``."""
    return {
        "word_count": c.per_text(_starts(~c.has(WHITE))),
        "line_count": c.per_text(np.flatnonzero(c.units == 10)) + 1,
        "char_count": c.ends - c.begins,
    }


def reading(c: Chunk) -> dict[str, np.ndarray]:
    """Words, sentences and syllables that ``metrics.readability`` is made of."""
    kept = np.flatnonzero(c.flags & KEPT)
    flags, low = c.flags[kept], c.low[kept]
    ends = np.flatnonzero(low == 0)
    word = (flags & (LETTER | DIGIT)) != 0
    word |= low == ord("_")
    first = word & ~_after(word, False)
    n_words = _counts(np.flatnonzero(first), ends)

    # Stretches between closing marks; their words are those of the text without punctuation, cut at the marks.
    stretch = np.cumsum(c.has(STOP), dtype=np.int32)
    here = stretch[kept]
    begins = first | (word & (np.diff(here, prepend=-1) != 0))
    longer = np.flatnonzero(np.bincount(here[begins], minlength=1) >= 3)
    n_sentences = np.maximum(_counts(longer, stretch[c.ends]), 1)

    vowel = (flags & VOWEL) != 0
    groups = _starts(vowel)
    words_at = np.cumsum(first, dtype=np.int32)[groups]
    with_vowel = groups[np.diff(words_at, prepend=-1) != 0]
    consonant = ((flags & LETTER) != 0) & ~vowel
    final = np.flatnonzero((low[1:-1] == ord("e")) & ~word[2:] & consonant[:-2]) + 1
    others = np.flatnonzero(~consonant)
    at = np.searchsorted(others, final) - 1
    final, before = final[at >= 0], others[at[at >= 0]]
    silent = final[vowel[before] & ((low[final - 1] != ord("l")) | (final - before == 2))]
    n_syllables = _counts(groups, ends) - _counts(silent, ends) + n_words - _counts(with_vowel, ends)
    return {"words": n_words, "sentences": n_sentences, "syllables": n_syllables}


_CLITICS = ("s", "m", "d", "ll", "re", "ve")


def density(c: Chunk) -> dict[str, np.ndarray]:
    """Content words and tokens that ``metrics.lexical_density`` is made of."""
    letter, digit, feed = c.has(LETTER), c.has(DIGIT), c.units == 10
    words, starts = c.runs(letter)
    content = ~_in(words, FUNCTION_WORDS)
    single = np.flatnonzero((c.flags & (LETTER | DIGIT | BLANK)) == 0)
    total = c.per_text(starts) + c.per_text(_starts(digit)) + c.per_text(_starts(feed)) + c.per_text(single)
    n_content = c.per_text(starts[content])

    # Clitics: an apostrophe and the whole run of letters after it.
    quotes = np.flatnonzero((c.units == ord("'")) | (c.units == ord("’")))
    quotes = quotes[letter[quotes + 1]]
    run = np.searchsorted(starts, quotes + 1)
    follows = words.take(pa.array(run))
    text = np.searchsorted(c.ends, quotes)
    clitic = _in(follows, _CLITICS)
    np.subtract.at(total, text[clitic], 1)
    np.subtract.at(n_content, text[clitic & content[run]], 1)
    negated = np.flatnonzero(_in(follows, ("t",)) & (quotes > 0) & (c.low[quotes - 1] == ord("n")) & (quotes - 1 >= c.begins[text]))
    if len(negated):
        quotes, run, text = quotes[negated], run[negated], text[negated]
        stem = pc.utf8_slice_codeunits(words.take(pa.array(run - 1)), 0, -1)
        alone = quotes - starts[run - 1] == 1
        kept = ~_in(stem, FUNCTION_WORDS) & ~alone
        curly = c.units[quotes] == ord("’")
        np.subtract.at(total, text, 1 + alone)
        np.add.at(n_content, text, kept.astype(int) + (curly if "n't" in FUNCTION_WORDS else True) - content[run] - content[run - 1])
    return {"content": n_content, "tokens": total}


@lru_cache(maxsize=4)
def _lexicon(rules: tuple) -> tuple[pa.Array, dict[str, np.ndarray]]:
    """Words the rules know, and what they are; the last place stands for all others."""
    valence, up, down, negations = dict(rules[0]), rules[1], rules[2], rules[3]
    names = {"up": up, "down": down, "negates": negations, "never": ("never",), "so": ("so", "this"), "least": ("least",),
             "very": ("at", "very"), "but": ("but",)}
    known = sorted({w for members in names.values() for w in members} | {w for w, v in valence.items() if v})
    found = {n: np.array([w in set(members) for w in known] + [False]) for n, members in names.items()}
    found["value"] = np.array([float(valence.get(w, 0.0)) for w in known] + [0.0])
    return pa.array(known, pa.string()), found


def rating(c: Chunk, rules: sentiment.Rules) -> np.ndarray:
    """Sum of the token scores, as ``sentiment.compound`` has it before emphasis."""
    known, is_ = _lexicon((tuple(rules.valence.items()), rules.boosters_up, rules.boosters_down, rules.negations))
    inside = ~c.has(WHITE)
    starts = _starts(inside)
    ends = np.flatnonzero(~inside & _after(inside, False))
    bare = np.flatnonzero(inside & ~c.has(PUNCT))
    if len(bare):  # edge punctuation goes, unless there is nothing else
        first, last = np.searchsorted(bare, starts), np.searchsorted(bare, ends)
        some = first < last
        starts = np.where(some, bare[np.minimum(first, len(bare) - 1)], starts)
        ends = np.where(some, bare[last - 1] + 1, ends)
    longer = ends - starts > 1
    starts, ends = starts[longer], ends[longer]
    total = np.zeros(len(c.ends))
    if not len(starts):
        return total
    text, size = np.searchsorted(c.ends, starts), ends - starts
    firsts = np.concatenate(([0], np.cumsum(size)[:-1]))
    places = np.arange(size.sum()) + np.repeat(starts - firsts, size)
    tokens = c.strings(places, firsts)
    code = pc.fill_null(pc.index_in(tokens, value_set=known), len(known)).to_numpy(zero_copy_only=False)
    value = is_["value"][code]
    rated = np.flatnonzero(value != 0)
    if not len(rated):
        return total

    cases = np.bitwise_or.reduceat(c.flags[places] & (HAS_UPPER | HAS_LOWER), firsts)
    capital = cases == HAS_LOWER
    n_tokens = np.bincount(text, minlength=len(total))
    n_capital = np.bincount(text[capital], minlength=len(total))
    mixed = ((n_capital > 0) & (n_capital < n_tokens))[text]
    before = (np.cumsum(n_tokens) - n_tokens)[text]
    negates = is_["negates"][code] | np.asarray(pc.match_substring(tokens, "n't").to_numpy(zero_copy_only=False), bool)
    but = np.flatnonzero(is_["but"][code])
    first_but = np.full(len(total), -1)
    first_but[text[but[::-1]]] = but[::-1]

    def signed(v: np.ndarray, step: float) -> np.ndarray:
        return np.where(v > 0, step, -step)

    i, own = rated - before[rated], value[rated]
    score = own + np.where(mixed[rated] & capital[rated], signed(own, sentiment.CAPS_STEP), 0.0)
    for back in (1, 2, 3):
        j = np.maximum(rated - back, 0)
        applies = (i >= back) & (value[j] == 0)
        word = code[j]
        up, down = is_["up"][word], is_["down"][word]
        step = np.where(up, signed(score, sentiment.BOOST), signed(score, -sentiment.BOOST))
        step = step + np.where(mixed[j] & capital[j], signed(score, sentiment.CAPS_STEP), 0.0)
        boosted = score + sentiment.DISTANCE_WEIGHT[back - 1] * np.where(up | down, step, 0.0)
        factor = np.where(negates[j], sentiment.NEGATION_FACTOR, 1.0)
        if back > 1:
            so = is_["so"][code[np.maximum(rated - 1, 0)]]
            if back == 3:
                so = so | is_["so"][code[np.maximum(rated - 2, 0)]]
            factor = np.where(is_["never"][word] & so, sentiment.NEVER_SO[1 if back == 2 else 0], factor)
        score = np.where(applies, boosted * factor, score)
    j = np.maximum(rated - 1, 0)
    softened = (i >= 2) & is_["very"][code[np.maximum(rated - 2, 0)]]
    least = (i >= 1) & is_["least"][code[j]] & (value[j] == 0) & ~softened
    score = np.where(least, score * sentiment.NEGATION_FACTOR, score)
    score = np.where(is_["up"][code[rated]] | is_["down"][code[rated]], 0.0, score)
    pivot = first_but[text[rated]]
    weight = np.where(
        (pivot < 0) | (rated == pivot), 1.0, np.where(rated < pivot, sentiment.BUT_BEFORE, sentiment.BUT_AFTER))
    return np.bincount(text[rated], weights=score * weight, minlength=len(total))  # added up in order


# ---- words ------------------------------------------------------------------------------

_ENDING = re.compile(r"(?:n't|'(?:s|m|d|ll|re|ve)?)(?=\.?\Z)|\.(?='*\Z)")
_FUSED = re.compile(metrics.FUSED)


@lru_cache(maxsize=100_000)
def _words_of(chunk: str) -> tuple[str, ...] | None:
    """Alphabetic words of a stretch without blanks in lower case; None where the languages' word borders may differ."""
    stem = _ENDING.sub(" ", chunk)
    if any(w in stem for w in metrics.FUSED_WORDS):
        if not stem.isascii():
            return None
        stem = _FUSED.sub(lambda m: "".join(m.group(i) or "" for i in (1, 3, 5, 7)) + " " + "".join(m.group(i) or "" for i in (2, 4, 6, 8)), stem)
    letters = _tables()[0]
    return tuple(w for w in stem.split(" ") if w and all(letters[ord(x)] & LETTER for x in w))


def words(c: Chunk) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words as ``metrics.word_tokens`` finds them, the texts they are of, and texts left to it."""
    low, left = c.low, c.odd.copy()
    blank = c.has(BLANK | APART)
    digit = (low >= ord("0")) & (low <= ord("9"))
    blank[:-1] |= ((low == ord(":")) | (low == ord(",")))[:-1] & ~digit[1:]
    for mark in "-'.":  # pairs of hyphens and quotes, runs of full stops
        places = np.flatnonzero(low == ord(mark))
        if len(places) > 1:
            first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
            size = np.diff(np.append(first, len(places)))
            gone = np.where(size > 1, size, 0) if mark == "." else size // 2 * 2
            blank[places[np.arange(len(places)) - np.repeat(first, size) < np.repeat(gone, size)]] = True
    inside = ~blank
    starts, ends = _starts(inside), np.flatnonzero(blank & _after(inside, False))
    # Stretches of letters, with a full stop at the end or without.
    stopped = low[ends - 1] == ord(".")
    strange = np.flatnonzero(inside & ~c.has(LETTER))
    n_strange = np.searchsorted(strange, ends) - np.searchsorted(strange, starts)
    simple = (n_strange == stopped) & (ends - starts > stopped)
    firsts, size = starts[simple], (ends - stopped)[simple] - starts[simple]
    begins = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
    found = c.strings(np.arange(size.sum()) + np.repeat(firsts - begins, size), begins)
    text = np.searchsorted(c.ends, firsts)

    coded = found.dictionary_encode()
    fused = _in(coded.dictionary, metrics.FUSED_WORDS)
    more, whose = [], []
    if fused.any():
        split = fused[coded.indices.to_numpy()]
        more += [w for word in found.filter(pa.array(split)).to_pylist() for w in _words_of(word)]
        whose.append(np.repeat(text[split], 2))
        found, text = found.filter(pa.array(~split)), text[~split]

    rest = ~simple
    starts, ends = starts[rest], ends[rest]
    # Others have words only if they begin with a letter, or where a fused form is part of them.
    size = ends - starts
    if len(starts):
        begins = np.concatenate(([0], np.cumsum(size)[:-1]))
        others = c.strings(np.arange(size.sum()) + np.repeat(starts - begins, size), begins).dictionary_encode()
        pieces = [_words_of(w) for w in others.dictionary.to_pylist()]
        codes, of = others.indices.to_numpy(), np.searchsorted(c.ends, starts)
        unknown = np.array([p is None for p in pieces], bool)
        left[of[unknown[codes]]] = True
        n = np.array([len(p or ()) for p in pieces])
        some = np.flatnonzero(n[codes])
        more += [w for k in codes[some] for w in pieces[k]]
        whose.append(np.repeat(of[some], n[codes[some]]))
    if more:
        found = pa.concat_arrays([found, pa.array(more, pa.string())])
        text = np.concatenate([text, *whose])
    return found, text, left


def counted(c: Chunk, stopwords) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Per text its different words but for stopwords, sorted and joined by spaces, their counts, and whether it is left."""
    found, text, left = words(c)
    coded = found.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    counts = ~_in(coded.dictionary, stopwords)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    taken = counts[codes] & ~left[text] if len(codes) else np.zeros(0, bool)
    codes, text = codes[taken], text[taken]
    keys, n = np.unique(text * max(len(order), 1) + rank[codes], return_counts=True)
    whose, which = np.divmod(keys, max(len(order), 1))
    at = pa.array(np.concatenate(([0], np.cumsum(np.bincount(whose, minlength=len(left))))).astype(np.int32))
    different = coded.dictionary.take(pa.array(order[which]))
    return pc.binary_join(pa.ListArray.from_arrays(at, different), " "), pa.ListArray.from_arrays(at, pa.array(n.astype(np.int32))), left


def merged(rows: pa.RecordBatch, key: str) -> pa.RecordBatch:
    """Neighbouring rows of one key as one row: its words and counts, which are added up."""
    n = rows.num_rows
    runs = pc.run_end_encode(rows[key])
    lasts = np.asarray(runs.run_ends.to_numpy(zero_copy_only=False), np.int64) - 1
    if len(lasts) == n:
        return rows
    group = np.searchsorted(lasts, np.arange(n))
    split, lists = pc.split_pattern(rows["words"], " "), rows["counts"]
    coded = split.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    whose = np.repeat(group, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    keys = whose * len(order) + rank[coded.indices.to_numpy(zero_copy_only=False)]
    by_key = np.argsort(keys, kind="stable")
    keys = keys[by_key]
    firsts = np.flatnonzero(np.diff(keys, prepend=-1))
    sums = np.add.reduceat(lists.flatten().to_numpy(zero_copy_only=False)[by_key], firsts)
    whose, which = np.divmod(keys[firsts], len(order))
    at = pa.array(np.concatenate(([0], np.cumsum(np.bincount(whose, minlength=len(lasts))))).astype(np.int32))
    words = pc.binary_join(pa.ListArray.from_arrays(at, coded.dictionary.take(pa.array(order[which]))), " ")
    made = {"words": words, "counts": pa.ListArray.from_arrays(at, pa.array(sums))}
    kept = rows.take(pa.array(lasts))
    return pa.RecordBatch.from_arrays([made.get(f.name, kept[f.name]).cast(f.type) for f in rows.schema], schema=rows.schema)


def merge(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """``merged`` over batches in the order of ``key``: the last row waits for what follows."""
    held = None
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch["counts"]).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            limit = CHUNK_WORDS + (ends[start - 1] if start else 0)
            stop = max(int(np.searchsorted(ends, limit, side="right")), start + 1)
            some = batch.slice(start, stop - start)
            rows = merged(some if held is None else pa.concat_batches([held, some]), key)
            held = rows.slice(rows.num_rows - 1)
            yield rows.slice(0, rows.num_rows - 1)
            start = stop
    if held is not None:
        yield held


# ---- columns ----------------------------------------------------------------------------


def _column(text: Column, ddl: str, of_chunk: Callable[[Chunk], tuple[list[pa.Array], np.ndarray]], names: Sequence[str]) -> Column:
    """Struct of the arrays ``of_chunk`` makes; NULL for the texts it leaves. ``text`` may not be NULL."""

    def one(c: Chunk) -> pa.Array:
        arrays, left = of_chunk(c)
        return pa.StructArray.from_arrays(arrays, names, mask=pa.array(left))

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                done = [one(Chunk([""]))[:0]]  # what an empty batch gives
                yield pa.concat_arrays(done + [one(c) for c in chunks(texts)])
        finally:  # workers are reused by later stages
            pa.default_memory_pool().release_unused()

    return run(text)


SCORES = ("word_count", "line_count", "char_count", "words", "sentences", "syllables", "content", "tokens")


def scores(text: Column, rules: sentiment.Rules | None = None) -> Column:
    """Struct of the counts the metrics are made of, and the sum of the token scores as ``rating``."""
    rules = rules or sentiment.Rules()

    def of_chunk(c: Chunk):
        found = {**basic(c), **reading(c), **density(c)}
        return [pa.array(found[n].astype(np.int64)) for n in SCORES] + [pa.array(rating(c, rules))], c.odd

    ddl = ", ".join(f"{n} long" for n in SCORES) + ", rating double"
    return _column(text, ddl, of_chunk, (*SCORES, "rating"))


def word_counts(text: Column, stopwords: Sequence[str]) -> Column:
    """Struct of the different words of a text but for stopwords, sorted and joined by spaces, and their counts."""

    def of_chunk(c: Chunk):
        joined, n, left = counted(c, stopwords)
        return [joined, n], left

    return _column(text, "words string, counts array<int>", of_chunk, ("words", "counts"))

"""Tokenizer files as counters and encoders that remember the words of their worker.

A text is cut at white space into chunks that the tokenizer treats apart from each other, and each
distinct chunk is encoded once. Results equal the library's on the whole text: chunks that hold
anything but plain Latin letters, digits and signs go to the library as they are, and so does every
text of a tokenizer whose file does not say what the cuts rely on.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Callable

import tiktoken

CACHE = 200_000  # chunks, and words, a worker remembers

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[!-~\n{_LETTER}]*\Z").match
_BESIDE = re.compile(r"[^\S ] | [^\S ]").search  # a space next to other white space
_BETWEEN = re.compile(r"(?<=\S) (?=\S)").split
_SHORT_RUNS = re.compile(rf"[ \n]{{0,256}}+(?:[!-~{_LETTER}]{{1,256}}+(?:[ \n]{{1,256}}+|\Z))*+\Z").match
_SUFFIXES = r"'s|'t|'re|'ve|'m|'ll|'d"


def file_digest(path: str) -> str:
    """Version of a tokenizer: the digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary (a fixed, public mapping)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Encoder:
    """Any tokenizer file of the tokenizers library, text by text."""

    #: whether runs of white space and the ends of a text never matter
    ignores_space = False

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def forget(self) -> None:
        """Drop what is remembered."""

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        found = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        return found.tobytes()

    def count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


class _Chunks(dict):
    """Ids of the chunks seen so far, with what stands before each; a bounded memory."""

    def __init__(self, encode: Callable[[str], bytes], lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids = self[chunk] = self.encode(self.lead + chunk)
        return ids


class _ChunkedEncoder(Encoder):
    words: re.Pattern
    lead = ""

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        self.model = tokenizer.model
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.chunks = _Chunks(self._chunk, self.lead)
        self.known: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        if "<|" in chunk or not _PLAIN(chunk.lstrip(" ")):
            return super().ids(chunk)
        known, parts = self.known, []
        for word in self.words.findall(self.prepared(chunk)):
            found = known.get(word)
            if found is None:
                if len(known) >= CACHE:
                    known.clear()
                shown = "".join(map(self.letters.__getitem__, word.encode()))
                found = known[word] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            parts.append(found)
        return b"".join(parts)

    def prepared(self, chunk: str) -> str:
        return chunk


class ByteLevelEncoder(_ChunkedEncoder):
    """Byte-level vocabulary whose words may begin with one space.

    Where the merges of the file follow its ids, texts of plain letters, digits, signs, blanks and line
    ends, without very long runs, are encoded whole from the file's own vocabulary as ranks, which gives
    the same ids. In other texts a space between two visible characters always begins a word, so the
    text is cut before each.
    """

    lead = " "
    words = re.compile(rf"{_SUFFIXES}| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s+(?!\S)|\s+")

    def __init__(self, tokenizer, spec: dict):
        super().__init__(tokenizer)
        ranks = _ranks(spec, self.letters)
        self.ranked = ranks and tiktoken.Encoding(
            "ranks", pat_str=_BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        if self.ranked and "<|" not in text and _SHORT_RUNS(text):
            return array("I", self.ranked(text)).tobytes()
        chunks = text.split(" ")
        if "" in chunks or _BESIDE(text):
            chunks = _BETWEEN(text)
        return b"".join([self._chunk(chunks[0]), *map(self.chunks.__getitem__, chunks[1:])])

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4


def _ranks(spec: dict, letters: list[str]) -> dict[bytes, int] | None:
    """Vocabulary of a byte-level file as ranks, or None where its ids do not tell the order of its merges."""
    vocabulary = spec["model"]["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in merges]
    in_order = all(x < y for x, y in zip([-1, *made], made))
    parts_first = all(max(vocabulary.get(a, i), vocabulary.get(b, i)) < i for (a, b), i in zip(merges, made))
    extra = {t["content"] for t in spec.get("added_tokens", [])}
    own = {t: i for t, i in vocabulary.items() if t not in extra}
    byte_of = {letter: b for b, letter in enumerate(letters)}
    if not (in_order and parts_first and len(own) == len(merges) + 256 and byte_of.keys() <= own.keys()):
        return None
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in own.items()}


class WordLevelEncoder(_ChunkedEncoder):
    """Lower-case vocabulary with word ends that drops white space; no word spans any."""

    ignores_space = True
    words = re.compile(rf"{_SUFFIXES}|[{_LETTER}]+|[0-9]|[^\s0-9{_LETTER}]+")

    def prepared(self, chunk: str) -> str:
        return chunk.lower()

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4


class PieceEncoder(Encoder):
    """A sentencepiece model."""

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, num_threads=1)).tobytes()

    def count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, num_threads=1))


# What the files of the two chunked kinds say about themselves, and how byte-level texts are cut.
_BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _kind(spec: dict) -> type[Encoder]:
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    specials_apart = all(
        t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
        for t in spec.get("added_tokens", [])
    )
    plain = specials_apart and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")
    if plain and norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return ByteLevelEncoder
    steps = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    first, *rest = pre.get("pretokenizers", [{}])
    if (
        plain and steps == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": _WORD_PATTERN}
        and first.get("behavior") == "Removed" and first.get("invert") and len(rest) == 1
        and rest[0].get("type") == "ByteLevel" and not rest[0].get("use_regex") and not rest[0].get("add_prefix_space")
    ):
        return WordLevelEncoder
    return Encoder


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, one per worker."""
    if path.endswith(".model"):
        import sentencepiece

        return PieceEncoder(sentencepiece.SentencePieceProcessor(model_file=path))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kind = _kind(spec)
    return kind(tokenizer, spec) if kind is ByteLevelEncoder else kind(tokenizer)

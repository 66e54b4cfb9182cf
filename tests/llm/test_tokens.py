import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cantora.llm import token_cache
from cantora.llm.tokens import Encoder, PieceEncoder, encoder, file_digest

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = [
    "the", "Anna's", " ", "  ", "\n", "\t", "\r\n", "don't", "<|endoftext|>", "<|startoftext|>", "é", "é", "ß", "İ", "你好", "🙂",
    " ", "\u0085", "\x1c", "123", "½", "ªº", ",", ".", "!!", "'S", "ing", "​", "x",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_ids_equal_the_library(path, text):
    from array import array

    mine, library = encoder(path), Tokenizer.from_file(path)
    assert mine.ids(text) == array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
    assert type(mine) is not Encoder


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["The", "mill", " ", "  ", "\n", "\n\n", "'s", "'S", "é", "ÿ×", "42", "...", "|", "a" * 300, " " * 300, "<|", "_"]), max_size=20).map("".join))
def test_plain_texts_equal_the_library(text):
    from array import array

    mine, library = encoder(BYTE), Tokenizer.from_file(BYTE)
    assert mine.ranked
    assert mine.ids(text) == array("I", library.encode(text, add_special_tokens=False).ids).tobytes()


def test_every_entry_is_its_own_merge():
    """What the encoding by ranks relies on: each entry of the vocabulary merges to itself."""
    model = Tokenizer.from_file(BYTE).model
    entries = {t: i for t, i in Tokenizer.from_file(BYTE).get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}
    assert len(entries) == 50256
    assert all([t.id for t in model.tokenize(entry)] == [i] for entry, i in entries.items())


def test_sentencepiece():
    import sentencepiece

    mine = encoder(PIECE)
    assert isinstance(mine, PieceEncoder)
    assert mine.count("the old mill") == len(sentencepiece.SentencePieceProcessor(model_file=PIECE).encode("the old mill"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_normalisation_keeps_counts(text):
    import re

    library = Tokenizer.from_file(WORD)
    collapsed = re.sub(r"[ \t\r\n]+", " ", text).strip(" ")
    assert len(library.encode(text, add_special_tokens=False).ids) == len(library.encode(collapsed, add_special_tokens=False).ids)


def test_counts_and_cache(spark, odd_docs, tmp_path):
    cache = str(tmp_path / "cache")
    library = Tokenizer.from_file(WORD)
    texts = {(r["doc_id"], r["text"] or "") for r in odd_docs.collect()}
    expected = {(i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 2048) for i, t in texts}
    rows = token_cache.token_counts(odd_docs, WORD, cache).collect()
    assert len(rows) == 12 and {tuple(r) for r in rows} == expected
    stored = token_cache.read_cache(spark, cache, file_digest(WORD))
    assert stored.count() == stored.distinct().count() == 7  # distinct contents after normalisation

    before = set(stored.inputFiles())
    more = spark.createDataFrame([(1, "one"), (2, "two words"), (3, " one ")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in token_cache.token_counts(more, WORD, cache).collect()} == {1: 1, 2: 2, 3: 1}
    after = token_cache.read_cache(spark, cache, file_digest(WORD))
    assert after.count() == 8  # only "two words" was a miss
    assert before <= set(after.inputFiles())


def test_cached_counts_are_used(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    version = file_digest(WORD)
    from pyspark.sql import functions as F

    docs.select(token_cache.content_digest(F.col("text"), True).alias("digest"), F.lit(99).cast("long").alias("n_tokens")).write.parquet(
        f"{cache}/tokenizer={version}")
    assert token_cache.token_counts(docs, WORD, cache).first()["n_tokens"] == 99


def test_empty(no_docs):
    assert token_cache.token_counts(no_docs, WORD).count() == 0


def test_limit(spark):
    rng = random.Random(3)
    text = " ".join(rng.choice("abc") for _ in range(2049))
    docs = spark.createDataFrame([(1, text), (2, text[:-2])], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_tokens"], r["over_limit"]) for r in token_cache.token_counts(docs, WORD).collect()}
    assert got == {1: (2049, True), 2: (2048, False)}

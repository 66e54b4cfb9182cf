import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cantora.functions import batches
from cantora.functions import metrics as M
from cantora.functions.wordlists import STOPWORDS
from cantora.operators import enrich, wordfreq
from cantora.plans.model import STANDIN_RULES

WORDS = (
    "love good thin tion reth is not never so this least at very but most and of the Don't can't CAN’T cannot Cannot gonna gimme wanna "
    "n't 'n' 's it's we're rock'n'roll table these whole ale ee e. U.S.A. x'd.' I'm I’m -- --- ... .. ' '' ''' . , ,5 5,5 :a : ; ! ? ?! "
    "(ok) [x] “q” «fr» „ été Élan ÀÉ GOOD LOVE Love HATE! worst. kind_of x_1 1st 3.14 12:30 über straße ŉ ß ǅ Σας ΟΔΟΣ İ ı ſ ﬁ Жж 中文 "
    "² ½ Ⅷ é ́ \x85 \x1c \x0b \x00 😀 a😀b gonna-x x-cannot é-gonna cannot. wanna'. don't. doesn'T NEVER SO n’t n 't n't5 a'tt ll're"
).split(" ")
BETWEEN = [" "] * 6 + ["\n", ". ", ", ", "\t", "", "  ", "\r\n", "\n\n", "-", "'", ".", "! ", "\xa0", " ", "　"]


def same(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "track_id long, text string").repartition(4).cache()
    want = enrich.with_metrics(rows, rules=STANDIN_RULES)
    got = enrich.with_all_metrics(rows, STANDIN_RULES)
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    counted = wordfreq.unpacked_counts(wordfreq.packed_counts(rows))
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, wordfreq.track_words(rows).collect()))
    return rows


def test_random_texts_have_the_same_metrics_and_words(spark):
    random.seed(7)

    def text(words, between):
        return "".join(w + random.choice(between) for w in random.choices(words, k=random.choice([0, 1, 2, 3, 5, 12, 40])))

    plain = [w for w in WORDS if w.isascii() and "\0" not in w]
    texts = [text(*random.choice([(WORDS, BETWEEN), (plain, BETWEEN[:-3])])) for _ in range(800)]
    rows = same(spark, texts + ["", " ", "\0", "a" * 3_000 + " love"])
    left = rows.select(batches.scores(F.col("text")).isNull().cast("int").alias("n")).agg(F.sum("n")).first()[0]
    assert 0 < left < 400  # most are counted in batches, texts with unusual characters are not


def test_characters_of_the_common_scripts(spark):
    forms = "love{0} a{0}be {0} {0}{0}E {0}good{0} it{0}s B.{0}c n{0}t don{0}t XY{0} {0}thin WORD{0} x"
    same(spark, [forms.format(chr(i)) for first, last in ((0x1, 0x600), (0x1E00, 0x2100), (0xFB00, 0xFB10)) for i in range(first, last)])


def test_missing_text_counts_as_empty(spark):
    rows = spark.createDataFrame([(1, None), (2, "")], "track_id long, text string")
    a, b = (sorted(tuple(r)[2:] for r in f.collect()) for f in (enrich.with_all_metrics(rows), enrich.with_metrics(rows)))
    assert a == b and wordfreq.packed_counts(rows).count() == 0


@pytest.mark.parametrize("size", [1, 2, 100])
def test_rows_of_a_key_become_one_across_batches(monkeypatch, size):
    monkeypatch.setattr(batches, "CHUNK_WORDS", size)
    rows = [(None, "a b", [1, 2]), (None, "b", [1]), (3, "c", [2**40]), (4, "a z", [1, 1]), (4, "b z", [1, 1]), (4, "é z", [5, 1]), (5, "a", [1])]
    table = pa.table({
        "album_id": pa.array([r[0] for r in rows], pa.int64()), "words": [r[1] for r in rows],
        "counts": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})
    got = [tuple(r.values()) for b in batches.merge(iter(table.to_batches(max_chunksize=3)), "album_id") for r in b.to_pylist()]
    assert got == [(None, "a b", [1, 3]), (3, "c", [2**40]), (4, "a b z é", [1, 1, 3, 5]), (5, "a", [1])]

"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import tidy

BUCKETS = 1 << 14  # per n-gram length
ORDERS = (1, 2, 3)
PIECE = 1 << 20  # code points handled at once; pieces overlap, so no n-gram is lost
MAX_LANGUAGES = 512
UNKNOWN = "und"

_MULTIPLIERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket of every n-gram of the lower-cased text, in pieces of bounded size."""
    lowered = text.lower()
    for start in range(0, max(1, len(lowered)), PIECE):
        # the piece starts with what the n-grams across its border need
        lead = min(start, max(ORDERS) - 1)
        points = np.frombuffer(
            lowered[start - lead : start + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32
        )
        mixed = [points * m for m in _MULTIPLIERS]
        found = []
        for n in ORDERS:
            skip = max(0, lead - n + 1)
            if len(points) - skip < n:
                continue
            grams = mixed[0][skip : len(points) - n + 1].copy()
            for i in range(1, n):
                grams ^= mixed[i][skip + i : len(points) - n + 1 + i]
            grams *= np.uint32(668265263)
            found.append((grams >> np.uint32(18)).astype(np.int32) + (n - 1) * BUCKETS)
        if found:
            yield np.concatenate(found)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class NaiveBayes:
    """``weights`` holds log P(bucket | language), one row per bucket, and ``prior`` log P(language)."""

    languages: tuple[str, ...]
    weights: np.ndarray
    prior: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        """Most likely language, ties to the first in order, and its posterior probability."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        scores = self.prior.astype(np.float64).copy()
        for buckets in ngram_buckets(text):
            # sparse scoring: only the rows of the buckets that occur, in blocks of bounded size
            for at in range(0, len(buckets), 1 << 16):
                scores += self.weights[buckets[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(scores))
        return self.languages[best], float(1.0 / np.exp(scores - scores[best]).sum())


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams per (language, bucket) of one task, as few rows as there are pairs."""
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            text = text.as_py()
            if not has_letter(text):
                continue
            documents[lang] = documents.get(lang, 0) + 1
            own = counts.get(lang)
            if own is None:
                own = counts[lang] = np.zeros(len(ORDERS) * BUCKETS, dtype=np.int64)
            for buckets in ngram_buckets(text):
                if len(buckets) < BUCKETS:
                    np.add.at(own, buckets, 1)
                else:
                    own += np.bincount(buckets, minlength=len(own))
    for lang, own in counts.items():
        used = np.flatnonzero(own)
        buckets = np.append(used, -1).astype(np.int32)  # bucket -1 counts the documents
        yield pa.record_batch({
            "lang": pa.array([lang] * len(buckets), pa.string()), "bucket": pa.array(buckets),
            "n": pa.array(np.append(own[used], documents[lang])),
        })


def train(labelled: DataFrame) -> NaiveBayes:
    """Model of all ``labelled`` rows (text, lang); rows without lang or letters teach nothing.

    Tasks count, a shuffle adds the counts up; the driver gets languages x buckets sums, whatever the
    number of rows. Add-one smoothing; priors from the number of documents.
    """
    counted = (
        labelled.where("lang IS NOT NULL").select("text", "lang")
        .mapInArrow(tidy(_partial_counts), "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    table = counted.toPandas()
    languages = tuple(sorted(table["lang"].unique()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages, {MAX_LANGUAGES} at most: the matrix would not fit")
    column = {lang: i for i, lang in enumerate(languages)}
    grams = np.ones((len(ORDERS) * BUCKETS, len(languages)))
    prior = np.zeros(len(languages))
    at = table["lang"].map(column).to_numpy(dtype=np.int64)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    head = bucket < 0
    prior[at[head]] = n[head]
    np.add.at(grams, (bucket[~head], at[~head]), n[~head])
    for o in range(len(ORDERS)):  # each length is a distribution of its own
        part = grams[o * BUCKETS : (o + 1) * BUCKETS]
        part /= part.sum(axis=0, keepdims=True)
    prior = np.log(prior / prior.sum()) if len(languages) else prior
    return NaiveBayes(languages, np.log(grams).astype(np.float32), prior)


def predicted(df: DataFrame, model: NaiveBayes, text: str = "text") -> Column:
    """Struct (lang, score) of a text column; the matrix travels to each executor once."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [held.value.predict(t.as_py()) for t in texts]
            names, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.StructArray.from_arrays([names, scores], ["lang", "score"])

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tidy(scan)(batches)

    return predict(F.col(text))


def training_rows(docs: DataFrame) -> Column:
    """Rows to learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))


def identify(docs: DataFrame, model: NaiveBayes | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    Without a model, one is trained on the rows that are not held out; lang serves nothing else.
    score is the posterior probability of lang_pred.

    Defined cases: a NULL text, an empty one, or one without letters is ``und`` with score 0, and so is
    all when no row has a lang; a NULL lang is not learned from; a NULL doc_id is neither learned from
    nor held out; equal scores go to the first language in order; repeated rows are predicted each;
    an empty table gives no rows; further columns are ignored.
    """
    if model is None:
        model = train(docs.where(training_rows(docs)))
    result = predicted(docs, model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), result.alias("r")).select(
        "doc_id", "held_out", F.col("r.lang").alias("lang_pred"), F.col("r.score").alias("score")
    )

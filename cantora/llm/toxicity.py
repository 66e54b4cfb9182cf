"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Voters: lexicon entries (whole words and word stems) found by their gain on labelled toxic texts,
   each a voter of its own, and fixed patterns of insults and shouting.
2. A generative label model estimates how often each voter speaks on toxic and on other texts, by
   expectation maximisation, and discounts voters that move together given the label.
3. A linear classifier is fitted to the posterior labels; its weights score every text in one scan.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import stored, tidy

SAMPLE = 24_000  # labelled rows to fit on, the least hashes of their ids: a documented bound
SUPPORT = 5  # toxic texts that must hold a lexicon entry
LIFT = 8.0  # times likelier on toxic texts than on others
GAIN = 14.0  # log-likelihood gain over chance that an entry needs; chance passes once in e^14
STEMS = (4, 5, 6)  # lengths of word stems
BLOCK = 256  # voters whose correlations are held at once
CACHE = 50_000  # words a worker remembers

# Fixed patterns that vote beside the lexicon: name, pattern, and what every text that matches holds.
PATTERNS = (
    ("insult", re.compile(r"\b(?:you|u)\s+(?:are|r)\s+(?:an?\s+|such\s+)?(?:idiot|moron|stupid|loser|scum|trash)\b", re.I), ""),
    ("threat", re.compile(r"\b(?:kill|hurt|destroy)\s+(?:you|yourself|them)\b", re.I), ""),
    ("masked", re.compile(r"\b[a-z]+\*{2,}[a-z]*\b", re.I), "**"),
)
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def entries_of(word: str) -> tuple[str, ...]:
    """Lexicon entries a raw word speaks for: the word itself and its stems, marked by a star."""
    core = _EDGES.sub("", word)
    return (core, *(core[:n] + "*" for n in STEMS if len(core) > n)) if core else ()


def words_of(text: str | None) -> set[str]:
    """Distinct raw words of the whole lower-cased text."""
    return set(text.lower().split()) if text else set()


@dataclass
class Scorer:
    """Linear model over voters. ``score`` needs only the text."""

    voters: dict[str, int]
    weights: np.ndarray
    bias: float
    _known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def votes(self, text: str | None) -> list[int]:
        known, found = self._known, set()
        for word in words_of(text):
            hit = known.get(word)
            if hit is None:
                if len(known) >= CACHE:
                    known.clear()
                hit = known[word] = tuple(self.voters[e] for e in entries_of(word) if e in self.voters)
            if hit:
                found.update(hit)
        if text:
            found.update(self.voters[f"#{n}"] for n, p, sign in PATTERNS if f"#{n}" in self.voters and sign in text and p.search(text))
        return sorted(found)

    def forget(self) -> None:
        """Drop the words seen so far."""
        self._known.clear()

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[self.votes(text)].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))


def correlations(rows: np.ndarray, cols: np.ndarray, weight: np.ndarray, rate: np.ndarray, low: int = 0, high: int | None = None) -> np.ndarray:
    """Correlation of voters ``low`` to ``high`` (all) with every voter over rows of the given weights.

    ``rows`` ascend, and ``cols`` within a row.
    """
    size, total = len(rate), weight.sum()
    high = size if high is None else min(high, size)
    both = np.zeros((high - low, size))
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, int)
    for at, end in zip(starts, np.r_[starts[1:], len(rows)].astype(int)):
        own = cols[at:end]
        mine = own[np.searchsorted(own, low) : np.searchsorted(own, high)]
        if len(mine):
            both[np.ix_(mine - low, own)] += weight[rows[at]]
    spread = np.sqrt(rate * (1 - rate)) + 1e-9
    return (both / total - np.outer(rate[low:high], rate)) / np.outer(spread[low:high], spread)


def trust_of(rows: np.ndarray, cols: np.ndarray, q: np.ndarray, on1: np.ndarray, on0: np.ndarray) -> np.ndarray:
    """One over one plus the sum of a voter's correlations given the class; ``BLOCK`` rows of the matrix at a time."""
    sums = np.zeros(len(on1))
    for low in range(0, len(on1), BLOCK):
        high = min(low + BLOCK, len(on1))
        tied = np.maximum(correlations(rows, cols, q, on1, low, high), correlations(rows, cols, 1 - q, on0, low, high))
        tied[np.arange(high - low), np.arange(low, high)] = 0
        sums[low:high] = np.clip(tied - 0.1, 0, 1).sum(axis=1)
    return 1.0 / (1.0 + sums)


def label_model(votes: list[list[int]], labels: np.ndarray, size: int, rounds: int = 20) -> np.ndarray:
    """Posterior probability of toxic for each row of votes.

    Voters speak or stay silent. EM starts from the labelled rows: rates of speaking given each class,
    then posteriors, then rates again, with the labels as one more voter of estimated accuracy. Voters
    that speak together more often than their rates within a class explain (a stem and its words, say)
    are correlated; each one's log-odds are divided by one plus the sum of its correlations.
    """
    rows = np.repeat(np.arange(len(votes)), [len(v) for v in votes])
    cols = np.fromiter((j for v in votes for j in v), dtype=np.int64, count=len(rows))
    q = np.clip(labels.astype(float), 0.01, 0.99)
    trust = None
    for _ in range(rounds):
        total1, total0 = q.sum(), (1 - q).sum()
        on1 = (np.bincount(cols, q[rows], size) + 0.05) / (total1 + 1)
        on0 = (np.bincount(cols, 1 - q[rows], size) + 0.05 * (total0 + 1) / (total1 + 1)) / (total0 + 1)
        if trust is None:  # the dependence structure is learned once, from the labels
            trust = trust_of(rows, cols, q, on1, on0)
        speak = trust * np.log(on1 / on0)
        accuracy = np.clip(np.mean(np.where(labels == 1, q, 1 - q)), 0.6, 0.995)
        z = np.log(total1 / total0) + np.bincount(rows, speak[cols], len(votes))
        z += np.where(labels == 1, 1, -1) * np.log(accuracy / (1 - accuracy))
        new = np.clip(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))), 1e-4, 1 - 1e-4)
        moved, q = np.abs(new - q).max(), new
        if moved < 1e-4:
            break
    return q


def fit_linear(votes: list[list[int]], target: np.ndarray, size: int, epochs: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with a small ridge, by full-batch Adam in numpy."""
    rows = np.repeat(np.arange(len(votes)), [len(v) for v in votes])
    cols = np.fromiter((j for v in votes for j in v), dtype=np.int64, count=len(rows))
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, epochs + 1):
        z = b + np.bincount(rows, w[cols], len(votes))
        miss = (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - target) / len(votes)
        grad = np.append(np.bincount(cols, miss[rows], size) + 1e-6 * w, miss.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per entry of one task, flushed before the counter grows large."""
    def rows(counts):
        return pa.record_batch({"entry": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column("text"):
            counts.update({e for w in words_of(text.as_py()) for e in entries_of(w)})
            if len(counts) > 100_000:
                yield rows(counts)
                counts.clear()
    yield rows(counts)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Scorer fitted on the ``sample`` labelled rows whose ids hash lowest.

    The sample's ids are bounded, so they travel to the scan of the texts; no text of an unlabelled
    document moves. A document labelled more than once is toxic if one label says so; an id with several
    texts teaches by the least of them, so the rows to fit on are as many as the ids at most. Every
    entry beyond the thresholds is a voter.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(stored(chosen)), "doc_id")
    rows = stored(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Scorer({}, np.zeros(0), 40.0 if toxic and not clean else -40.0)

    def counted(part: DataFrame, name: str) -> DataFrame:
        return part.select("text").mapInArrow(tidy(_entry_counts), "entry string, n long").groupBy("entry").agg(F.sum("n").alias(name))

    on = counted(rows.where("toxic = 1"), "on").where(F.col("on") >= SUPPORT)
    both = on.join(counted(rows.where("toxic = 0"), "off"), "entry", "left").fillna(0, ["off"])
    # log-likelihood gain of an entry over chance; the threshold leaves room for millions of entries tried
    share = toxic / (toxic + clean)
    held_by = F.col("on") + F.col("off")
    gain = F.col("on") * F.log(F.col("on") / (held_by * share)) + F.when(
        F.col("off") > 0, F.col("off") * F.log(F.col("off") / (held_by * (1 - share)))
    ).otherwise(0.0)
    entries = [
        r["entry"] for r in both.withColumn("gain", gain).where((F.col("on") * clean >= LIFT * F.col("off") * toxic) & (F.col("gain") >= GAIN))
        .orderBy(F.desc("gain"), "entry").collect()
    ]
    voters = {e: i for i, e in enumerate([*entries, *(f"#{n}" for n, *_ in PATTERNS)])}
    held = spark.sparkContext.broadcast(Scorer(voters, np.zeros(len(voters)), 0.0))

    @F.arrow_udf("array<int>")
    def votes(texts: pa.Array) -> pa.Array:
        return pa.array([held.value.votes(t.as_py()) for t in texts], pa.list_(pa.int32()))

    voted = rows.select(votes("text").alias("votes"), "toxic").toPandas()
    cast = [list(v) for v in voted["votes"]]
    posterior = label_model(cast, voted["toxic"].to_numpy(), len(voters))
    weights, bias = fit_linear(cast, posterior, len(voters))
    return Scorer(voters, weights, bias)


def score_column(docs: DataFrame, scorer: Scorer, text: str = "text") -> Column:
    held = docs.sparkSession.sparkContext.broadcast(scorer)

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([held.value.score(t.as_py()) for t in texts], pa.float64())

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tidy(scan, lambda: held.value.forget())(batches)

    return score(F.col(text))


def toxicity(docs: DataFrame, labels: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    Without a scorer, one is trained from ``labels`` (doc_id, toxic), never from held-out rows. A score
    depends on the whole text alone.

    Defined cases: a NULL or empty text has the score of silence; a NULL label teaches nothing; a NULL
    doc_id is scored, and neither learned from nor held out; with no labels, or only one kind, every score is
    next to 0, or to 1 if all are toxic; repeated rows are scored each; an empty table gives no rows; further columns are ignored.
    """
    if scorer is None:
        scorer = train(docs, labels)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), score_column(docs, scorer).alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))

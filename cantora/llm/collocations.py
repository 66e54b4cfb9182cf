"""Phrase collocation mining by partitions: local mining, union, exact global counts.

1. The scan tasks are dealt over a fixed number of shards. A phrase that occurs ``support`` times in a
   language occurs at least ``support / SHARDS`` times in some shard, whatever the shards hold. Each shard
   is mined completely at that local support, words first, then pairs of frequent words, then longer
   phrases all of whose pairs are frequent. A shard is not what a task holds: tasks count their own rows,
   one run of a language at a time, and Spark adds up (shard, phrase).
2. The union of the locally frequent phrases is kept as a hash filter of fixed size. What it lets through
   by chance costs a count, nothing else.
3. A last scan counts all phrases of the union, whatever their local count, by their words, so the sums
   are exact and hashes decide nothing.

The number of shards is fixed, so the local support does not fall as the input grows. Only sums of
phrases per run are shuffled, which spreads a hot word or language over the runs. They travel as packed
blocks by phrase bucket; buckets grow in number with the bytes, and a task adds up one at a time.

Null and empty texts have no phrases; a null language is ``und``; repeated rows count as often as they
occur; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantora.llm.common import packed, stored, tidy, unpacked

SUPPORT = 100  # occurrences in a language
LENGTH = 5  # words at most
TOP = 2_000  # phrases reported per language
SHARE = 100  # percent of a phrase's occurrences inside a longer one from which it is dropped
UNKNOWN = "und"

SHARDS = 4
RUN_BYTES = 8 << 20  # text of one language a task counts at once
BUCKET_BYTES = 16 << 20  # text per bucket of phrases
CUT_BYTES = 2 << 20  # text split into words at once
FILTER_BITS = 1 << 27  # filter of candidates: 16 MB, whatever their number

_BREAK = -1
#: A-Z lower-cased, marks and line ends as line feeds, tabs as spaces.
_NORMAL = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Run(dict):
    """Texts of one language as word numbers; between pieces stands a break."""

    def __init__(self, lang: str):
        super().__init__({b"\n": _BREAK, b"": _BREAK - 1})
        self.lang = lang
        self.words: list[bytes] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def add(self, text: bytes) -> None:
        self.size += len(text)
        text, start = text.translate(_NORMAL), 0
        while start < len(text):
            end = start + CUT_BYTES
            if end < len(text):  # at a separator, or behind a word longer than that
                end = max(text.rfind(b" ", start, end), text.rfind(b"\n", start, end))
                if end < 0:
                    ends = [e for e in (text.find(b" ", start + CUT_BYTES), text.find(b"\n", start + CUT_BYTES)) if e >= 0]
                    end = min(ends, default=len(text))
                end += 1
            tokens = text[start:end].replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
            self.parts.append(ids[ids >= _BREAK].astype(np.int32))
            start = end
        self.parts.append(np.array([_BREAK], np.int32))

    def n_words(self) -> int:
        return sum(int((p >= 0).sum()) for p in self.parts)

    def phrases(self, keep: Callable[[int, np.ndarray], np.ndarray], longest: int) -> Iterator[Phrases]:
        """Distinct phrases by length, as far as ``keep`` (length, hashes) lets them pass.

        A phrase is looked at only if both its parts without the last and without the first word have
        passed. Phrases are told apart by their words; the hash also depends on the language.
        """
        ids = np.concatenate([*self.parts, np.full(longest + 1, _BREAK, np.int32)]).astype(np.int64)
        seed = xxhash.xxh3_64_intdigest(self.lang.encode("utf-8", "surrogatepass"))
        known = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in self.words], np.uint64)
        at = np.flatnonzero(ids >= 0)
        group, hashes = ids[at], np.zeros(len(known), np.uint64)
        for length in range(1, longest + 1):
            if length > 1:
                alive = np.zeros(len(ids), bool)
                alive[at] = True
                on = alive[at + 1] & (ids[at + length - 1] >= 0)
                at, group = at[on], group[on]
                group = group * len(known) + ids[at + length - 1]
            if not len(at):
                return
            key, first, number, counts = np.unique(group, return_index=True, return_inverse=True, return_counts=True)
            before = hashes[key // len(known)] if length > 1 else np.zeros(len(key), np.uint64)
            found = (before * _FACTOR) ^ known[ids[at[first] + length - 1]]
            found = (found ^ (found >> np.uint64(29))) * _MIX
            found ^= found >> np.uint64(32)
            good = keep(length, found)
            starts = at[first[good]]
            yield Phrases(length, found[good], counts[good], ids[starts[:, None] + np.arange(length)])
            passed = good[number]
            at, group = at[passed], (np.cumsum(good) - 1)[number[passed]]
            hashes = found[good]


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases of one length in a run: hashes, counts and rows of word numbers."""

    length: int
    hashes: np.ndarray
    counts: np.ndarray
    words: np.ndarray

    def text(self, run: Run) -> pa.Array:
        vocabulary = pa.array(run.words, pa.binary())
        columns = [vocabulary.take(pa.array(self.words[:, i])) for i in range(self.length)]
        joined = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())) if self.length > 1 else columns[0]
        return joined


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    """The rows of a task by language, each run as soon as it is full."""
    held: dict[str, Run] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            run = held.get(lang) or held.setdefault(lang, Run(lang))
            run.add(text.as_py())
            if run.size >= RUN_BYTES:
                yield held.pop(lang)
        if sum(r.size for r in held.values()) >= 2 * RUN_BYTES:  # many languages
            yield held.pop(max(held, key=lambda x: held[x].size))
    yield from held.values()


class Filter:
    """Bitmap of fixed size with the slots of hashes set."""

    def __init__(self):
        self.bits = np.zeros(FILTER_BITS >> 6, np.uint64)

    def add(self, hashes: DataFrame) -> None:
        slot = f"(hash & {FILTER_BITS - 1})"
        words = hashes.groupBy(F.expr(f"shiftright({slot}, 6)").alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast({slot} & 63 as int))")).alias("bits"))
        found = words.toPandas()  # at most one row a word of the bitmap
        self.bits[found["word"].to_numpy(np.int64)] |= found["bits"].to_numpy(np.int64).view(np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & np.uint64(FILTER_BITS - 1)
        return ((self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def prepared(docs: DataFrame) -> DataFrame:
    """(lang, text as bytes) of the rows with text."""
    return docs.where("text is not null and text <> ''").select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))


def _dealt(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, numbers of its phrases)."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), part


def _summed(blocks: DataFrame, add: Callable[[str, list[bytes]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """``add`` over the rows (bucket, label, block) of every bucket and label, one after the other."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in ("bucket", "label", "block")]))
        for (_, label), group in groupby(rows, key=lambda r: r[:2]):
            yield from add(label, [unpacked(r[2]) for r in group])

    sorted_ = blocks.repartition("bucket", "label").sortWithinPartitions("bucket", "label")
    return sorted_.mapInArrow(tidy(scan), ddl)


_BLOCKS = "bucket int, label string, block binary"


def _block(bucket: int, label: str, data: bytes) -> pa.RecordBatch:
    columns = [pa.array([bucket], pa.int32()), pa.array([label], pa.string()), pa.array([packed(data)], pa.binary())]
    return pa.record_batch(columns, names=["bucket", "label", "block"])


def locally_frequent(texts: DataFrame, known: Filter, shortest: int, longest: int, least: int, buckets: int) -> DataFrame:
    """Hashes of the phrases of ``shortest`` to ``longest`` words with ``least`` occurrences in some shard.

    Shorter phrases must have passed before; ``known`` holds them.
    """
    held = texts.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = str(TaskContext.get().partitionId() % SHARDS)
        for run in runs(batches):
            for found in run.phrases(lambda n, h: held.value(h) if n < shortest else np.ones(len(h), bool), longest):
                if found.length < shortest:
                    continue
                for bucket, i in _dealt(found.hashes, buckets):
                    yield _block(bucket, shard, found.hashes[i].tobytes() + found.counts[i].astype(np.int64).tobytes())

    def add(_: str, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([np.frombuffer(b, np.uint64, len(b) // 16) for b in blocks])
        counts = np.concatenate([np.frombuffer(b, np.int64, offset=len(b) // 2) for b in blocks])
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        begins = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        often = begins[np.add.reduceat(counts, begins) >= least]
        yield pa.record_batch([pa.array(hashes[often].view(np.int64))], names=["hash"])

    return _summed(texts.mapInArrow(tidy(scan), _BLOCKS), add, "hash long")


def candidates(texts: DataFrame, support: int, longest: int, buckets: int) -> Filter:
    """The union of what is locally frequent in any shard."""
    least = -(-support // SHARDS)
    found = Filter()
    for shortest, upto in ((1, 1), (2, 2), (3, longest)):
        if longest >= shortest:
            found.add(locally_frequent(texts, found, shortest, upto, least, buckets))
    return found


def counted(texts: DataFrame, union: Filter, support: int, longest: int, buckets: int) -> DataFrame:
    """(lang, phrase, a): the phrases of the union with ``support`` occurrences; phrase null: all words of the language."""
    held = texts.sparkSession.sparkContext.broadcast(union)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            yield _block(0, run.lang, _counts(np.array([run.n_words()]), [b""]))  # the empty phrase: all words
            for found in run.phrases(lambda _, h: held.value(h), longest):
                text = found.text(run)
                for bucket, i in _dealt(found.hashes, buckets):
                    yield _block(bucket, run.lang, _counts(found.counts[i], text.take(pa.array(i)).to_pylist()))

    def add(lang: str, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        sums: dict[bytes, int] = {}
        for data in blocks:
            m = int(np.frombuffer(data, np.int64, 1)[0])
            for phrase, n in zip(data[8 + 8 * m :].split(b"\n"), np.frombuffer(data, np.int64, m, 8).tolist()):
                sums[phrase] = sums.get(phrase, 0) + n
        often = [(p, n) for p, n in sums.items() if n >= support or not p]
        phrase = pa.array([p or None for p, _ in often], pa.binary()).cast(pa.string())
        yield pa.record_batch([pa.array([lang] * len(often), pa.string()), phrase, pa.array([n for _, n in often], pa.int64())],
                              names=["lang", "phrase", "a"])

    return _summed(texts.mapInArrow(tidy(scan), _BLOCKS), add, "lang string, phrase string, a long")


def _counts(counts: np.ndarray, phrases: list[bytes]) -> bytes:
    """Counts and phrases, a line feed between two: no word holds one."""
    return np.r_[len(phrases), counts].astype(np.int64).tobytes() + b"\n".join(phrases)


def n_words(phrase: Column) -> Column:
    return F.size(F.split(phrase, " "))


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LENGTH, top: int = TOP, share: int = SHARE) -> DataFrame:
    """Each language's best phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    The score of a phrase is that of its weakest cut in two, floor(1000 a n / (l r)) with the counts of the
    two parts. A phrase is dropped if a phrase one word longer holds it in ``share`` percent of its
    occurrences; a longer one than that would imply it.
    """
    texts = prepared(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    found = stored(counted(texts, candidates(texts, support, longest, buckets), support, longest, buckets))
    totals = found.where("phrase is null").select("lang", F.col("a").alias("n"))
    counts = found.where("phrase is not null")
    phrases = counts.where(n_words(F.col("phrase")) >= 2)

    longer = phrases.where(n_words(F.col("phrase")) >= 3)
    first_part = F.expr("substring(phrase, 1, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)")
    last_part = F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)")
    inside = (
        longer.select("lang", F.explode(F.array(first_part, last_part)).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    kept = phrases.join(inside, ["lang", "phrase"], "left").where(
        f"longer is null or 100 * longer < {share} * a").drop("longer")

    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), n_words(F.col("phrase")) - 1)))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    scored = cuts.withColumn("score", F.expr(
        "(1000BD * cast(a as decimal(18, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    ))
    weakest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    phrases = weakest.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

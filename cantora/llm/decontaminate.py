"""Benchmark decontamination by template windows with consistent slots.

Numbers, names and units become typed placeholders; windows of tokens are hashed, plain and as
templates, and joined with those of the benchmark. A template match counts only where the slots of
the benchmark item map to the slots of the document one value to one value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import document_key, stored, tidy

WINDOW = 8  # tokens
MATCHED = 6  # distinct windows of an item a document must hold, or all if the item has fewer: 13 tokens in a row
SHORTEST = 5  # tokens; shorter items are no evidence and are left out
LITERAL = 3  # tokens of a full template window that must not be slots, in proportion for shorter ones
FILTER_WORDS = 1 << 16  # 64-bit words of the window filter: 512 KB, whatever the benchmark's size
CACHE = 150_000  # chunks a worker remembers
BLOCK = 250_000  # characters of text looked at together

# Unit words that are slots after a number.
UNITS = frozenset("""
mm cm m km inch inches in ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons oz lb lbs
pound pounds ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day
days week weeks month months year years percent % cent cents dollar dollars usd eur euro euros gbp degree degrees celsius
fahrenheit kmh mph w kw kwh hz khz mhz ghz b kb mb gb tb
""".split())

PLAIN, TEMPLATE = 0, 1
_WORD, _NUMBER, _NAME, _UNIT, _NOTHING = range(5)
_CORE = re.compile(r"^[^\w%]+|[^\w%]+$|^_+|_+$")
_SIGNS = "!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII signs but the percent sign, which is a unit
_DIGIT = re.compile(r"\d").search
_AMOUNT = re.compile(r"\d(?=[^\W\d_]|%)|[$€£](?=\d)")
_NUMERIC = re.compile(r"[+-]?\d[\d.,:/]*\Z").match
_SLOT_HASH = np.array([xxhash.xxh64_intdigest(f"\0slot{k}") for k in range(5)], np.uint64)  # of each kind
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

HIT_SCHEMA = "key binary, pos int, hash long, kind int, slots array<long>"


class Tokens(dict):
    """For each chunk of text its token's hash, the kind in the lowest three bits; remembered."""

    def __missing__(self, chunk: str) -> int:
        core = chunk
        if not core.isalpha():
            core = chunk.strip(_SIGNS)
            if not core.isalnum():
                core = _CORE.sub("", chunk)
        lower = core.lower()
        if not core:
            kind = _NOTHING
        elif lower in UNITS:
            kind = _UNIT
        elif core[0].isupper():
            kind = _NAME if len(core) > 1 and not core.isupper() else _WORD
        elif core.isalpha() or not _NUMERIC(core):
            kind = _WORD
        else:
            kind = _NUMBER
        token = self[chunk] = xxhash.xxh64_intdigest(lower) & -8 | kind
        return token

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, kinds, places of their texts) of the tokens of some texts, one after the other.

        A unit word without a number before it is a word.
        """
        if len(self) > CACHE:
            self.clear()
        chunks, counts = [], []
        for text in texts:
            if _DIGIT(text):
                text = _AMOUNT.sub(r"\g<0> ", text)
            found = text.split()
            chunks += found
            counts.append(len(found))
        hashes = np.fromiter(map(self.__getitem__, chunks), np.uint64, len(chunks))
        owner = np.repeat(np.arange(len(texts)), counts)
        kinds = (hashes & np.uint64(7)).astype(np.int8)
        hashes &= np.uint64(2**64 - 8)  # a name is the same token as the word in lower case
        kept = kinds != _NOTHING
        if not kept.all():
            hashes, kinds, owner = hashes[kept], kinds[kept], owner[kept]
        units = np.flatnonzero(kinds == _UNIT)
        if len(units):
            alone = units[(units == 0) | (kinds[units - 1] != _NUMBER) | (owner[units - 1] != owner[units])]
            kinds[alone] = _WORD
        return hashes, kinds, owner


def rolled(values: np.ndarray, size: int, tag: int) -> np.ndarray:
    """Hash of every window of ``size`` values; ``tag`` keeps sizes and kinds apart.

    The polynomial of a window is put together from those of its halves, so the work grows with the
    logarithm of the size.
    """
    n = len(values) - size + 1
    whole, length = None, 0  # polynomial of the first ``length`` values of each window
    power, span = values, 1  # polynomial of ``span`` values from each place on
    while True:
        if size & span:
            if whole is None:
                whole = power[:n]
            else:
                whole = whole * _power(span) + power[length : length + n]
            length += span
        if 2 * span > size:
            break
        power = power[:-span] * _power(span) + power[span:]
        span *= 2
    h = whole + np.uint64(tag * 1000003 + size)
    h ^= h >> np.uint64(31)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def windows_of(tokens: Tokens, texts: list[str], sizes: list[int], bits: np.ndarray | None) -> Iterator[tuple]:
    """(place of the text, pos, hash, kind, slot hashes) of the windows of some texts.

    All texts are one run of tokens, from which windows across borders are left out. Only those that the
    filter ``bits`` lets through are returned.
    """
    hashes, kinds, owner = tokens.of(texts)
    start = np.searchsorted(owner, np.arange(len(texts)))
    slot = kinds != _WORD
    masked = np.where(slot, _SLOT_HASH[kinds], hashes)
    slots_before = np.r_[0, np.cumsum(slot)]
    for size in sizes:
        if len(hashes) < size:
            continue
        for kind, values in ((PLAIN, hashes), (TEMPLATE, masked)):
            h = rolled(values, size, kind)
            if bits is None:
                passed = np.arange(len(h))
            else:
                word = bits[(h >> np.uint64(48)).view(np.int64)]
                passed = np.flatnonzero((word >> (h & np.uint64(63))) & np.uint64(1))
            passed = passed[owner[passed] == owner[passed + size - 1]]
            if kind == TEMPLATE:
                in_window = slots_before[passed + size] - slots_before[passed]
                passed = passed[(in_window > 0) & ((size - in_window) * WINDOW >= LITERAL * size)]
            at = owner[passed]
            for p, text, pos, value in zip(
                passed.tolist(), at.tolist(), (passed - start[at]).tolist(), h[passed].view(np.int64).tolist()
            ):
                own = hashes[p : p + size][slot[p : p + size]].view(np.int64).tolist() if kind == TEMPLATE else []
                yield text, pos, value, kind, own


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    """Keys and texts of a batch, as many at a time as hold ``BLOCK`` characters, a longer text alone."""
    keys, texts, held = [], [], 0
    for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
        if not text.is_valid:
            continue
        text = text.as_py()
        if texts and held + len(text) > BLOCK:
            yield keys, texts
            keys, texts, held = [], [], 0
        keys.append(key)
        texts.append(text)
        held += len(text)
    if texts:
        yield keys, texts


def windows(texts: DataFrame, sizes: list[int], bits: np.ndarray | None = None) -> DataFrame:
    """Windows (key, pos, hash, kind, slots) of ``texts`` (key, text)."""
    held = texts.sparkSession.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        schema = pa.schema([
            ("key", pa.binary()), ("pos", pa.int32()), ("hash", pa.int64()), ("kind", pa.int32()), ("slots", pa.list_(pa.int64())),
        ])
        for batch in batches:
            for keys, block in _blocks(batch):
                rows = [(keys[at], *window) for at, *window in windows_of(tokens, block, sizes, held.value)]
                columns = list(zip(*rows)) if rows else [[], [], [], [], []]
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return texts.select("key", "text").mapInArrow(tidy(scan), HIT_SCHEMA)


def _n_tokens(text: Column) -> Column:
    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        tokens = Tokens()
        return pd.Series([len(tokens.of([t or ""])[0]) for t in texts], dtype="int32")

    return count(text)


def held_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document key and benchmark item it holds: key, item_id, n_matched, n_windows, templated."""
    spark = docs.sparkSession
    items = benchmark.where("text IS NOT NULL").select("item_id", "text").withColumn("n", _n_tokens(F.col("text"))).where(
        f"n >= {SHORTEST}"
    ).withColumn("size", F.least("n", F.lit(WINDOW)))
    keyed = stored(items.withColumn("key", F.unhex(F.md5(F.concat_ws("\0", F.col("item_id").cast("string"), F.lit("|"), "text")))))
    parts = []
    sizes = sorted(r["size"] for r in keyed.select("size").distinct().collect())  # at most WINDOW
    for size in sizes:
        parts.append(windows(keyed.where(F.col("size") == size), [size]))
    if not parts:
        return spark.createDataFrame([], f"key binary, item_id {benchmark.schema['item_id'].dataType.simpleString()}, "
                                         "n_matched long, n_windows int, templated boolean")
    theirs = parts[0]
    for p in parts[1:]:
        theirs = theirs.union(p)
    theirs = stored(
        theirs.join(keyed.select("key", "item_id", (F.col("n") - F.col("size") + 1).alias("n_windows")), "key")
        .select("item_id", "n_windows", F.col("pos").alias("item_pos"), "hash", "kind", F.col("slots").alias("item_slots"),
                F.col("key").alias("item_key"))
    )
    word = F.shiftrightunsigned("hash", 48)
    bits = np.zeros(FILTER_WORDS, np.uint64)
    for r in theirs.groupBy(word.alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")).alias("bits")
    ).toLocalIterator():
        bits[r["word"]] = np.int64(r["bits"]).astype(np.uint64)

    rows = docs.select("text", document_key(docs).alias("key"))
    hits = stored(windows(rows.where("text IS NOT NULL"), sizes, bits))
    met = hits.join(theirs, ["hash", "kind"])
    spot = ["key", "item_key", "item_id", "n_windows", (F.col("pos") - F.col("item_pos")).alias("shift")]
    plain = met.where(F.col("kind") == PLAIN).select(*spot, "item_pos", F.lit(False).alias("templated"))
    slotted = met.where(F.col("kind") == TEMPLATE).select(*spot, "item_pos", F.arrays_zip("item_slots", "slots").alias("pairs"))
    place = ["key", "item_key", "shift"]
    clashes = (
        slotted.select(*place, F.explode("pairs").alias("p")).select(*place, "p.item_slots", "p.slots").distinct()
        .groupBy(*place, "item_slots").count().where("count > 1").select(*place).distinct()
    )
    consistent = slotted.join(clashes, place, "left_anti").select(
        *[c if isinstance(c, str) else "shift" for c in spot], "item_pos", F.lit(True).alias("templated")
    )
    return (
        plain.union(consistent)
        .groupBy("key", "item_key", "item_id", "n_windows", "item_pos").agg(F.min("templated").alias("templated"))
        .groupBy("key", "item_key", "item_id", "n_windows").agg(F.count("*").alias("n_matched"), F.max("templated").alias("templated"))
        .where(F.col("n_matched") >= F.least(F.lit(MATCHED), F.col("n_windows")))
        .groupBy("key", "item_id").agg(
            F.max("n_matched").alias("n_matched"), F.max("n_windows").alias("n_windows"), F.max("templated").alias("templated"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item it holds: key, doc_id, item_id, n_matched, n_windows, templated.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text). n_matched counts the distinct windows of
    the item found, at least ``MATCHED`` or all of them; templated says that some were found only with
    other numbers, names or units.

    A filter of fixed size, built from the hashes of the benchmark, is all the scan of the texts needs;
    what passes goes to the hash join, which is exact and which adaptive execution splits where many
    documents hold one passage.

    Defined cases: NULL or empty texts hold nothing; items of fewer than ``SHORTEST`` tokens are left
    out, and one shorter than a window is a window of its own length; a NULL doc_id or item_id is
    reported as such; repeated rows, and items repeated under one id, are reported once; an empty table
    on either side gives no rows; further columns are ignored.
    """
    found = held_items(docs, benchmark)
    rows = docs.select("doc_id", document_key(docs).alias("key"))
    ids = rows.join(found.select("key").distinct(), "key", "left_semi").distinct()
    return found.join(ids, "key").select("key", "doc_id", "item_id", "n_matched", "n_windows", "templated")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept.

    The texts stream past a hash of the keys dealt to their task; a sort would hold them in memory.
    """
    held = held_items(docs, benchmark).select(F.col("key").alias("_held")).distinct()
    return docs.join(held.hint("shuffle_hash"), document_key(docs) == F.col("_held"), "left_anti")

"""Near-duplicate groups: MinHash bands, odd sketches, confirmation on full shingle sets.

1. Documents with equal shingle sets are one class; everything below handles classes.
2. MinHash values are cut into bands; classes that share a band are candidates. In each bucket only
   the pairs with its hub are looked at, the member that meets most others across all buckets.
3. The odd sketches of a pair, parity bitmaps of the MinHash values, estimate its similarity from the
   population count of their XOR; pairs clearly below the threshold go no further. The rest are
   confirmed on full sets.
4. Buckets whose members still lie in several components have pairs no hub has settled. Their members
   meet again by the rarest shingles of each set (prefix and place filter on exact counts, exact for the
   threshold), only across components, and pass the same two tests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import stored, tidy
from cantora.llm.components import connected_components

SHINGLE = 5  # words
BANDS, ROWS = 32, 4  # a pair at 0.80 shares no band with probability 5e-8, at 0.85 5e-11
SKETCH_WORDS = 8  # 64-bit words of an odd sketch
SIGMAS = 5.0  # standard errors of the estimate a pair may lie below the threshold before it is dropped
FILTER_BITS = 1 << 26  # 8 MB, the fixed size of the filter of candidate classes
WORD_CACHE = 150_000  # words a worker remembers

_VALUES = BANDS * ROWS
_random = np.random.default_rng(5)
_FACTORS = (_random.integers(0, 1 << 32, _VALUES, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_OFFSETS = _random.integers(0, 1 << 32, _VALUES, dtype=np.uint64).astype(np.uint32)[:, None]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, a public-domain generator."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler(dict):
    """Sorted distinct 64-bit hashes of the five-word shingles of a text; remembers the hashes of words."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower and bytes.split know A-Z and ASCII white space only, as the definition does
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self) > WORD_CACHE:
            self.clear()
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        size = min(SHINGLE, len(words))
        n = len(words) - size + 1
        h = np.full(n, size, np.uint64)
        for j in range(size):
            h = h * _BASE + hashes[j : j + n]
        return np.unique(_mixed(h))


def minhash(shingles: np.ndarray) -> np.ndarray:
    values = np.full(_VALUES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        block = short[at : at + 4096] * _FACTORS
        block += _OFFSETS
        np.minimum(values, block.min(axis=1), out=values)
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    rows = values.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        h = _mixed(h * _BASE + rows[:, r])
    return h.view(np.int64)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Each MinHash value, with its place, flips one bit."""
    spot = _mixed(values.astype(np.uint64) + (np.arange(_VALUES, dtype=np.uint64) << np.uint64(32)))
    bit = (spot % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_flips(threshold: float) -> int:
    """Largest population count of an XOR that still allows the threshold.

    With k values and n bits, a pair of similarity s differs in about 2k(1 - s) values and
    n/2 (1 - exp(-4k(1 - s)/n)) bits. The lowest similarity allowed lies ``SIGMAS`` standard errors
    of k samples below the threshold, and the count as many standard errors of its own above.
    """
    k, n = _VALUES, 64 * SKETCH_WORDS
    low = max(0.0, threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / k))
    expected = n / 2 * (1 - math.exp(-4 * k * (1 - low) / n))
    return int(expected + SIGMAS * math.sqrt(n * math.exp(-4 * k * (1 - low) / n) / 4 + 1))


def similar(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


@dataclass(frozen=True)
class Prefixes:
    """How many of the rarest shingles of a set of ``n`` must be looked at, for a similarity in percent."""

    percent: int

    def probe(self, n: Column) -> Column:
        """Against sets no larger than this one."""
        return (n - F.ceil(self.percent * n / 100) + 1).cast("int")

    def index(self, n: Column) -> Column:
        """Against sets at least as large as this one."""
        return (n - F.ceil(2 * self.percent * n / (100 + self.percent)) + 1).cast("int")


def signatures(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, key, text): its class, set size, bands and sketch. Empty sets have no class."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.select("doc_id", "key").schema}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler()
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            classes, sizes, bands, sketches = [], [], [], []
            for text in batch.column("text"):
                shingles = shingles_of(text.as_py())
                name = xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None
                known = seen.get(name) if name else ([], [])
                if known is None:
                    values = minhash(shingles)
                    known = (band_keys(values).tolist(), odd_sketch(values).tolist())
                    if len(seen) >= 2000:
                        seen.clear()
                    seen[name] = known
                classes.append(name)
                sizes.append(len(shingles))
                bands.append(known[0])
                sketches.append(known[1])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "key": batch.column("key"), "class": pa.array(classes, pa.binary()),
                "n": pa.array(sizes, pa.int64()), "bands": pa.array(bands, pa.list_(pa.int64())),
                "sketch": pa.array(sketches, pa.list_(pa.int64())),
            })

    return docs.select("doc_id", "key", "text").mapInArrow(
        tidy(scan), f"doc_id {kinds['doc_id']}, key {kinds['key']}, class binary, n long, bands array<long>, sketch array<long>"
    )


def _filter_of(classes: DataFrame) -> np.ndarray:
    """Bitmap of fixed size over the first bytes of the classes' names: no false absence."""
    head = F.conv(F.hex(F.substring("class", 1, 4)), 16, 10).cast("long")
    bit = head.bitwiseAND(F.lit(FILTER_BITS - 1))
    words = classes.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")
    )
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    table = words.toArrow()  # FILTER_BITS / 64 rows at most
    bitmap[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return bitmap


def shingle_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, shingles) of the given classes, from a second scan of the texts.

    Full sets are larger than the texts, so those of classes that are no candidates are never stored:
    a filter of fixed size tells most of them in the scan, the join all of them. Each task emits a
    class once.
    """
    held = docs.sparkSession.sparkContext.broadcast(_filter_of(classes))
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of, seen = Shingler(), set()
        for batch in batches:
            names, sets = [], []
            for text in batch.column("text"):
                shingles = shingles_of(text.as_py())
                if not len(shingles):
                    continue
                name = xxhash.xxh3_128_digest(shingles.tobytes())
                bit = int.from_bytes(name[:4], "big") & (FILTER_BITS - 1)
                if not (int(held.value[bit >> 6]) >> (bit & 63)) & 1 or name in seen:
                    continue
                if len(seen) < 100_000:
                    seen.add(name)
                names.append(name)
                sets.append(shingles.tobytes())
            yield pa.record_batch({"class": pa.array(names, pa.binary()), "shingles": pa.array(sets, pa.binary())})

    sets = docs.select("text").mapInArrow(tidy(scan), "class binary, shingles binary")
    return sets.join(classes.select("class").distinct(), "class", "left_semi").dropDuplicates(["class"])


def close_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose odd sketches allow the threshold."""
    one = sketches.select(F.col("class").alias("a"), F.col("sketch").alias("sa"))
    two = sketches.select(F.col("class").alias("b"), F.col("sketch").alias("sb"))
    flips = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return pairs.join(one, "a").join(two, "b").where(flips <= most_flips(percent / 100)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) similar enough on their full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(similar(common, len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("xa"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("xb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "xa", "xb").mapInArrow(tidy(compare), "a binary, b binary")


def _tokens(sets: DataFrame) -> DataFrame:
    """(token, class) of every shingle of ``sets``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("shingles")]
                owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
                yield pa.record_batch({
                    "token": pa.array(np.concatenate(found)), "class": part.column("class").take(pa.array(owner)),
                })

    return sets.select("class", "shingles").mapInArrow(tidy(emit), "token long, class binary")


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``sets`` (class, component, shingles) in different components that may be similar.

    Two sets as similar as asked share a shingle among the first few of each in any common order. The
    order is by the exact number of sets that hold a shingle, rarest first. So the shingles of one set
    alone, which lead to no pair, come first and use up the prefix: sets of a group that differ by more
    than the threshold allows do not meet at what the group has in common, however large it is. The
    smaller set of a pair needs fewer shingles (index) than the larger (probe), and the places of the
    first one they share bound what they can have in common.
    """
    prefixes = Prefixes(percent)
    # written first, so that adaptive execution may split a token that very many sets hold
    shared = stored(_tokens(sets).groupBy("token").agg(F.count("*").alias("held_by")).where("held_by > 1"))
    common = _tokens(sets).join(shared, "token").groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("held_by", "token"))).alias("common"))  # of one set's own shingles
    n = (F.octet_length("shingles") / 8).cast("int")
    sized = sets.select("class", "component", n.alias("n"))
    placed = common.join(sized, "class").withColumn("alone", F.col("n") - F.size("common"))
    first = F.slice("common", F.lit(1), F.greatest(prefixes.probe(F.col("n")) - F.col("alone"), F.lit(0)))
    rows = stored(
        placed.select("class", "component", "n", "alone", F.posexplode(first).alias("at", "shingle"))
        .withColumn("at", F.col("alone") + F.col("at"))
        .select(F.col("shingle.token").alias("token"), "class", "component", "n", "at", (F.col("at") < prefixes.index(F.col("n"))).alias("index"))
    )
    # only tokens that several components share, and an index row among them, can lead to a pair
    useful = rows.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.bool_or("index").alias("any")
    ).where("any AND lo <> hi").select("token")
    rows = rows.join(useful, "token", "left_semi")
    small = rows.where("index").select(
        "token", F.col("class").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("at").alias("ia"))
    large = rows.select(
        "token", F.col("class").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("at").alias("ib"), "index")
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    met = small.join(large, "token").where(
        (F.col("ca") != F.col("cb")) & (100 * F.col("na") >= percent * F.col("nb"))
        & ((100 + percent) * most >= percent * (F.col("na") + F.col("nb")))
        & ((F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & F.col("index") & (F.col("a") < F.col("b")))
    )
    return met.select("a", "b").distinct()


def class_links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) that join the classes (class, bands, sketch) of ``docs`` into their groups."""
    member = classes.select("class", F.explode("bands").alias("bucket"))
    crowded = member.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    member = stored(member.join(crowded, "bucket"))
    reach = member.groupBy("class").agg(F.sum("m").alias("reach"))
    hubs = member.join(reach, "class").groupBy("bucket").agg(
        F.max(F.struct("reach", "class"))["class"].alias("hub")
    )
    member = stored(member.join(hubs, "bucket"))
    sketches = stored(classes.join(reach.select("class"), "class", "left_semi").select("class", "sketch"))
    sets = stored(shingle_sets(docs, reach.select("class")))

    starred = member.where("class <> hub").select(
        F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()
    links = stored(confirmed(close_pairs(starred, sketches, percent), sets, percent))
    groups = connected_components(links)

    placed = member.join(groups.withColumnRenamed("node", "class"), "class", "left").select(
        "bucket", "class", "hub", F.coalesce("component", "class").alias("component"))
    open_buckets = placed.where("class <> hub").groupBy("bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    unsettled = placed.join(open_buckets, "bucket", "left_semi").select("class", "component").distinct()
    rest = prefix_pairs(stored(sets.join(unsettled, "class")), percent)
    return links.union(confirmed(close_pairs(rest, sketches, percent), sets, percent))


def near_duplicates(docs: DataFrame, percent: int = 85, key: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set holds the distinct
    five-word shingles, or the whole sequence of fewer words. Documents are linked where
    100 x intersection >= ``percent`` x union; a group is what links reach, and its id its smallest
    doc_id. With ``key``, a binary column of ``docs``, that column is returned as well, and of several
    rows under the group's id only those of the least key are kept.

    Defined cases: a NULL text, and one without words, has an empty set and is linked with nothing; a NULL
    doc_id never names a group that has another, and alone is its own group; repeated rows are in one
    group and each kept; an empty table gives no rows; further columns are ignored.
    """
    named = docs.select("doc_id", "text", (F.col(key) if key else F.lit(None).cast("binary")).alias("key"))
    rows = stored(signatures(named))
    whole = rows.where("class IS NOT NULL")
    classes = stored(whole.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")
    ))
    groups = stored(connected_components(class_links(named, classes, percent)))
    placed = classes.select("class", "first").join(groups.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "first", F.coalesce("component", "class").alias("component"))
    names = placed.groupBy("component").agg(F.min("first").alias("head"))
    of_class = stored(placed.join(names, "component").select(
        "class", F.col("head.doc_id").alias("component_id"), F.col("head.key").alias("head_key")))
    result = rows.select("doc_id", "key", "class", F.col("n").alias("n_shingles")).join(of_class, "class", "left").withColumn(
        "component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    head = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("class").isNull() | F.col("key").eqNullSafe(F.col("head_key")))
    return result.select(
        "doc_id", "n_shingles", "component_id", head.alias("kept"),
        *([F.col("key").alias(key)] if key else []),
    )


def one_of_each_group(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that head their group, all columns kept; of rows repeated whole, one.

    Of several rows under the group's id, which may differ in other columns, the one of the least digest
    over all columns stays, so a repeated task picks the same.
    """
    rest = [docs[c] for c in docs.columns if c not in ("doc_id", "text")]
    others = [F.to_json(F.struct(*rest))] if rest else []
    digest = F.unhex(F.md5(F.concat_ws("\0", docs["doc_id"].cast("string"), F.lit("|"), docs["text"], *others)))
    keyed = docs.withColumn("_key", digest)
    kept = near_duplicates(keyed.select("doc_id", "text", "_key"), percent, key="_key").where("kept").select("_key").distinct()
    return keyed.dropDuplicates(["_key"]).join(kept, "_key", "left_semi").select(*[keyed[c] for c in docs.columns])

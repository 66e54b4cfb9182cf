"""Repeated byte strings by blockwise suffix sorting over a cover sample.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id.

1. Cover sample: of every ``LENGTH``-byte string the leftmost smallest of its hashed ``SEED``-byte strings is
   sampled, so every suffix has a sampled place within ``REACH`` bytes, and two equal strings have it at the
   same distance. About one place in fifteen is sampled. The sampled strings are ranked bucket by bucket; only
   whether a rank is held by several documents matters, so documents get back the ranks they share.
2. Suffixes whose sampled place has a shared rank are bucketed by that rank, as the text from the first to the
   last of them. Suffixes of a bucket already agree in the sampled bytes, and the bucket is sorted on its own:
   equal prefixes of ``LENGTH`` bytes meet, the smallest id among them is the first holder. Each task first does
   the same to its own texts, and sends only suffixes that no smaller id of its own has settled.
3. The removed suffixes of each document are merged into spans.

What a task holds is one bucket; buckets grow in number with the bytes, not in size. A cover by residues (a
difference cover) has the same place for each pair of equal strings only pair by pair, so a string with many
copies would be looked at once for each pair of residues, and holds three times as many places; the sampled
places here serve all copies at once.

Hash collisions change nothing: sampled strings only choose what is looked at, and equal suffixes are
compared byte by byte. Null texts are empty, a null doc_id is greater than every other, rows with the same
doc_id never remove from each other, other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import packed, tidy, unpacked
from cantora.llm.decontaminate import rolled

LENGTH = 50  # bytes of a string that counts as repeated
SEED = 20  # bytes of a sampled string
REACH = LENGTH - SEED + 1  # places among which one is sampled
GROUP_BYTES = 1 << 18  # text looked at at once; places in it take 18 bits
LOCAL_BYTES = 4 << 20  # text whose suffixes a task settles among themselves
RANK_BUCKET_BYTES = 32 << 20  # text per bucket of sampled strings
SUFFIX_BUCKET_BYTES = 8 << 20  # text per bucket of suffixes
SORT_AT_ONCE = 1 << 18  # suffixes
HASH_AT_ONCE = 1 << 18  # bytes of a bucket

_LAST = (1 << 63) - 1  # stands for a null doc_id
_BYTES = np.random.default_rng(12).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_PLACE = np.uint64(GROUP_BYTES - 1)
_LOW = np.uint64((1 << 32) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the given stretches, one stretch after the other; in four bytes each where they fit."""
    before = np.cumsum(lengths) - lengths
    kind = np.int32 if not len(starts) or max(starts.max(), before[-1]) + lengths.max() < 1 << 31 else np.int64
    found = np.repeat((starts - before).astype(kind), lengths)
    found += np.arange(len(found), dtype=kind)
    return found


def _short(ranks: np.ndarray) -> bytes:
    """The low four bytes of each rank. Buckets do not grow, so in one they hardly ever meet by chance."""
    return (ranks & _LOW).astype("<u4").tobytes()


def _long(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4").astype(np.uint64)


@dataclass(frozen=True)
class Sample:
    """Sampled places of some texts: the suffixes from ``first`` to ``last`` share the rank of one place."""

    text: np.ndarray  # number of the text
    shift: np.ndarray  # what to add to a place to get the place in the document
    first: np.ndarray
    last: np.ndarray
    rank: np.ndarray


def groups(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, Sample]]:
    """(bytes, sample) of groups of texts; a longer text is cut, with an overlap, so that no suffix is lost."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def close() -> tuple[np.ndarray, Sample]:
        lengths = np.array([len(piece) for _, _, piece in held])
        ends = np.cumsum(lengths)
        buf = np.frombuffer(b"".join(piece for _, _, piece in held), np.uint8)
        piece = np.repeat(np.arange(len(held)), lengths)
        keys = _mixed(rolled(_BYTES[buf], SEED, 1))
        least = (keys & ~_PLACE) | np.arange(len(keys), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < REACH:
            rest = REACH - width
            least = np.minimum(least[:-rest], least[rest:])
        at = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends[piece[: len(least)]])
        place = (least[at] & _PLACE).astype(np.int64)
        begins = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else at
        stops = np.r_[begins[1:] - 1, len(at) - 1] if len(at) else at
        shift = np.array([offset for _, offset, _ in held]) - (ends - lengths)
        own = piece[at[begins]]
        number = np.array([n for n, _, _ in held])
        return buf, Sample(number[own], shift[own], at[begins], at[stops], _mixed(keys[place[begins]] + np.uint64(1)))

    for n, text in enumerate(texts):
        if text is None or len(text) < LENGTH:
            continue
        for start in range(0, len(text) - LENGTH + 1, GROUP_BYTES - LENGTH):
            piece = text[start : start + GROUP_BYTES - 1]
            if size + len(piece) >= GROUP_BYTES:
                yield close()
                held, size = [], 0
            held.append((n, start, piece))
            size += len(piece)
    if held:
        yield close()


def _by_bucket(ranks: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = ((ranks >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def _binary(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


# ---- texts on their way through a shuffle ---------------------------------------------------


def with_packed(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the bytes column ``text`` compressed: it is what makes a shuffle of documents large."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [None if t is None else packed(t) for t in _binary(batch, text)]
            yield batch.set_column(batch.schema.get_field_index(text), text, pa.array(held, pa.binary()))

    return rows.mapInArrow(scan, rows.schema)


# ---- ranks of the cover sample ------------------------------------------------------------


_RANKS = pa.schema([("bucket", pa.int32()), ("ranks", pa.binary()), ("docs", pa.binary())])


def shared_ranks(texts: DataFrame, buckets: int) -> DataFrame:
    """(doc, ranks): per document the ranks of its sampled strings that another document also holds."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc").to_numpy()
            found = [(s.rank, docs[s.text]) for _, s in groups(_binary(batch, "text"))]
            if not found:
                continue
            ranks, owners = (np.concatenate(x) for x in zip(*found))
            rows = [(b, _short(ranks[i]), owners[i].tobytes()) for b, i in _by_bucket(ranks, buckets)]
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _RANKS)], schema=_RANKS)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _buckets(batches, ["ranks", "docs"]):
            ranks = _long(b"".join(r for r, _ in rows))
            docs = np.frombuffer(b"".join(d for _, d in rows), np.int64)
            order = np.argsort(ranks, kind="stable")
            ranks, docs = ranks[order], docs[order]
            begins = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
            several = np.minimum.reduceat(docs, begins) != np.maximum.reduceat(docs, begins)
            kept = np.repeat(several, np.diff(np.r_[begins, len(ranks)]))
            ranks, docs = ranks[kept], docs[kept]
            rows = [(g, _short(ranks[i]), docs[i].tobytes()) for g, i in _by_bucket(_mixed(docs.view(np.uint64)), buckets)]
            if rows:
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _RANKS)], schema=_RANKS)

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _buckets(batches, ["ranks", "docs"]):
            ranks = _long(b"".join(r for r, _ in rows))
            docs = np.frombuffer(b"".join(d for _, d in rows), np.int64)
            order = np.argsort(docs, kind="stable")
            ranks, docs = ranks[order], docs[order]
            cuts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1], True])
            all_ = _short(ranks)
            parts = [all_[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.record_batch([pa.array(docs[cuts[:-1]]), pa.array(parts, pa.binary())], names=["doc", "ranks"])

    def dealt(blocks: DataFrame) -> DataFrame:
        return blocks.repartition("bucket").sortWithinPartitions("bucket")

    ddl = "bucket int, ranks binary, docs binary"
    several = dealt(texts.select("doc", "text").mapInArrow(tidy(sample), ddl)).mapInArrow(tidy(shared), ddl)
    return dealt(several).mapInArrow(tidy(by_document), "doc long, ranks binary")


def _buckets(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of one bucket after the other, from batches sorted by bucket."""
    bucket, held = None, []
    for batch in batches:
        for b, *row in zip(batch.column("bucket").to_pylist(), *[batch.column(c).to_pylist() for c in columns]):
            if b != bucket and held:
                yield bucket, held
                held = []
            bucket = b
            held.append(tuple(row))
    if held:
        yield bucket, held


# ---- suffixes of a bucket -----------------------------------------------------------------


@dataclass(frozen=True)
class Suffixes:
    """Stretches of text with ``n`` suffixes each: rank, document (id and text digest) and place in it."""

    buf: np.ndarray
    n: np.ndarray
    rank: np.ndarray
    doc: np.ndarray
    digest: np.ndarray
    place: np.ndarray

    def begins(self) -> np.ndarray:
        lengths = self.n + LENGTH - 1
        return np.cumsum(lengths) - lengths

    def pick(self, which: np.ndarray, skip: np.ndarray | None = None, n: np.ndarray | None = None) -> Suffixes:
        """Stretches by number, cut to ``n`` suffixes after the first ``skip``."""
        skip = np.zeros(len(which), np.int64) if skip is None else skip
        n = self.n[which] if n is None else n
        buf = self.buf[_ragged(self.begins()[which] + skip, n + LENGTH - 1)]
        return Suffixes(buf, n, self.rank[which], self.doc[which], self.digest[which], self.place[which] + skip)

    def block(self) -> bytes:
        head = np.array([len(self.n)], np.int64).tobytes()
        parts = [x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in (self.n, self.rank.view(np.int64), self.doc, self.digest, self.place)]
        return packed(head + b"".join(parts) + self.buf.tobytes())

    @staticmethod
    def joined(blocks: list[bytes]) -> Suffixes:
        parts = []
        for data in map(unpacked, blocks):
            m = int(np.frombuffer(data, np.int64, 1)[0])
            columns = [
                np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * m, 8 + 8 * m * i).reshape(8, m).T).view("<i8").reshape(-1)
                for i in range(5)
            ]
            parts.append((np.frombuffer(data, np.uint8, offset=8 + 40 * m), *columns))
        buf, n, rank, doc, digest, place = (np.concatenate(x) for x in zip(*parts))
        return Suffixes(buf, n, rank.view(np.uint64), doc, digest, place)

    def settled(self) -> np.ndarray:
        """For each suffix whether its first ``LENGTH`` bytes are also those of a suffix with a smaller id.

        Seventeen bytes a suffix are held throughout; what takes more is done a stretch of bytes or a share of the
        suffixes at a time.
        """
        lengths = self.n
        order = np.argsort(self.doc, kind="stable")  # so the first of equal suffixes has the smallest id
        by_doc = self.pick(order)
        buf, at = by_doc.buf, _ragged(by_doc.begins(), by_doc.n)
        of = np.repeat(np.arange(len(order), dtype=np.int32), by_doc.n)
        keys = np.empty(len(at), np.uint64)
        for start in range(0, len(buf) - LENGTH + 1, HASH_AT_ONCE):
            a, b = np.searchsorted(at, (start, start + HASH_AT_ONCE))
            if a < b:
                hashes = rolled(_BYTES[buf[start : start + HASH_AT_ONCE + LENGTH - 1]], LENGTH, 2)
                keys[a:b] = hashes[at[a:b] - start]
        words = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
        found = np.zeros(len(at), bool)
        parts = min(-(-len(at) // SORT_AT_ONCE), 1 << 16)
        share = ((keys >> np.uint64(16)) % np.uint64(max(parts, 1))).astype(np.uint16)
        for part in range(parts):
            own = np.flatnonzero(share == part).astype(np.int32)
            if not len(own):
                continue
            by_key = own[np.argsort(keys[own], kind="stable")]
            sorted_ = keys[by_key]
            new = np.r_[True, sorted_[1:] != sorted_[:-1]]
            first = by_key[new][np.cumsum(new) - 1]
            later = by_doc.doc[of[by_key]] > by_doc.doc[of[first]]
            a, b = by_key[later], first[later]
            same = np.ones(len(a), bool)
            for step in (*range(0, LENGTH - 8, 8), LENGTH - 8):
                same &= words[at[a] + step] == words[at[b] + step]
            found[a[same]] = True
            if not same.all():  # different strings with one key
                held: dict[bytes, int] = {}
                for i in own[np.isin(keys[own], keys[a[~same]])].tolist():
                    string, doc = buf[at[i] : at[i] + LENGTH].tobytes(), int(by_doc.doc[of[i]])
                    found[i] = held.setdefault(string, doc) < doc
        out = np.zeros(len(at), bool)
        begins = np.cumsum(lengths) - lengths
        out[_ragged(begins[order], lengths[order])] = found
        return out

    def stretches(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of chosen suffixes: (stretch, suffixes before the run, length of the run)."""
        of = np.repeat(np.arange(len(self.n), dtype=np.int32), self.n)
        edge = np.r_[True, of[1:] != of[:-1]]
        starts = np.flatnonzero(chosen & (edge | ~np.r_[False, chosen[:-1]]))
        stops = np.flatnonzero(chosen & np.r_[edge[1:] | ~chosen[1:], True])
        which = of[starts]
        return which, starts - (np.cumsum(self.n) - self.n)[which], stops - starts + 1


_FOUND = pa.schema([
    ("bucket", pa.int32()), ("block", pa.binary()), ("doc", pa.int64()), ("digest", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
])
_FOUND_DDL = "bucket int, block binary, doc long, digest long, start long, stop long"


def _spans(found: Suffixes, chosen: np.ndarray) -> pa.RecordBatch:
    """Spans covered by the chosen suffixes, merged where they touch."""
    which, skip, n = found.stretches(chosen)
    doc, digest = found.doc[which], found.digest[which]
    start = found.place[which] + skip
    stop = start + n + LENGTH - 1
    order = np.lexsort((start, digest, doc))
    doc, digest, start, stop = doc[order], digest[order], start[order], stop[order]
    if len(doc):
        other = np.r_[True, (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])]
        # stretches of one text are sorted; a span ends where the next begins behind all before it
        number = np.cumsum(other)
        reach = np.maximum.accumulate(stop + number * (1 << 44)) - number * (1 << 44)
        begins = np.flatnonzero(other | np.r_[True, start[1:] > reach[:-1]])
        doc, digest, start = doc[begins], digest[begins], start[begins]
        stop = reach[np.r_[begins[1:] - 1, len(reach) - 1]]
    m = len(doc)
    place = (doc % 65_521).astype(np.int32)  # only deals the rows out
    return pa.record_batch([pa.array(place), pa.nulls(m, pa.binary()), *[pa.array(x.astype(np.int64)) for x in (doc, digest, start, stop)]], schema=_FOUND)


def suffix_blocks(joined: DataFrame, buckets: int) -> DataFrame:
    """Suffixes with shared ranks as blocks by bucket, and the spans a task can settle by itself."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Suffixes] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            found = _all(held)
            settled = found.settled()
            yield _spans(found, settled)
            which, skip, n = found.stretches(~settled)
            left = found.pick(which, skip, n)
            rows = [(b, left.pick(i).block(), None, None, None, None) for b, i in _by_bucket(left.rank, buckets)]
            if rows:
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)

        for batch in batches:
            docs, digests = batch.column("doc").to_numpy(), batch.column("digest").to_numpy()
            known = [_long(b"".join(x or [])) for x in batch.column("ranks").to_pylist()]
            copies = [set(x or []) for x in batch.column("copies").to_pylist()]
            texts = [unpacked(t) for t in _binary(batch, "text")]
            whole = [digests[i] in copies[i] for i in range(len(texts))]
            if any(whole):
                rows = [(d % 65_521, None, d, g, 0, len(t)) for d, g, t, w in zip(docs.tolist(), digests.tolist(), texts, whole) if w]
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)
            for buf, s in groups([None if w or not len(k) else t for t, w, k in zip(texts, whole, known)]):
                numbers = np.unique(s.text)
                order = np.searchsorted(numbers, s.text).astype(np.uint64) << np.uint64(48)
                shared = np.concatenate([known[n] | (np.uint64(i) << np.uint64(48)) for i, n in enumerate(numbers.tolist())])
                kept = np.flatnonzero(np.isin((s.rank & _LOW) | order, shared))
                if not len(kept):
                    continue
                first, n, of = s.first[kept], (s.last - s.first + 1)[kept], s.text[kept]
                held.append(Suffixes(buf[_ragged(first, n + LENGTH - 1)], n, s.rank[kept], docs[of], digests[of], first + s.shift[kept]))
                size += len(held[-1].buf)
                if size >= LOCAL_BYTES:
                    yield from close()
                    held, size = [], 0
        if held:
            yield from close()

    return joined.select("doc", "digest", "text", "ranks", "copies").mapInArrow(tidy(scan), _FOUND_DDL)


def _all(parts: list[Suffixes]) -> Suffixes:
    return Suffixes(*[np.concatenate([getattr(p, name) for p in parts]) for name in ("buf", "n", "rank", "doc", "digest", "place")])


def repeated_spans(blocks: DataFrame) -> DataFrame:
    """(doc, digest, start, stop): spans to remove, each bucket sorted on its own."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rest() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                block = batch.column("block").is_valid()
                spans = batch.filter(pa.compute.invert(block))
                if len(spans):
                    ready.append(spans)
                yield batch.filter(block)

        ready: list[pa.RecordBatch] = []
        for _, rows in _buckets(rest(), ["block"]):
            yield from ready
            ready.clear()
            found = Suffixes.joined([r[0] for r in rows])
            yield _spans(found, found.settled())
        yield from ready

    return blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(scan), _FOUND_DDL).select(
        "doc", "digest", "start", "stop")


def remaining(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left) of a text and spans that may overlap."""
    kept, at, runs, removed = [], 0, 0, 0
    reach = -1
    for start, stop in sorted(spans):
        if start > reach:
            runs += 1
            kept.append(text[at:start])
        reach = at = max(reach, stop)
    kept.append(text[at:])
    left = b"".join(kept)
    removed = len(text) - len(left)
    return removed, runs, left


def repeated_strings(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, its packed text, and the spans (start, stop) to remove, in bytes."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")
    texts = docs.select("doc_id", doc, F.xxhash64("text").alias("digest"), F.col("text").cast("binary").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    long = texts.where(F.octet_length("text") >= LENGTH)

    # rows whose text is that of a smaller id as a whole need no suffixes
    whole = long.select("doc", "digest", F.md5("text").alias("whole"), F.octet_length("text").alias("size"))
    firsts = whole.groupBy("whole", "size").agg(F.min("doc").alias("first"))
    copies = whole.join(firsts, ["whole", "size"]).where("doc > first").groupBy("doc").agg(F.collect_set("digest").alias("copies"))

    ranks = shared_ranks(long, max(1, -(-total // RANK_BUCKET_BYTES)))
    known = ranks.groupBy("doc").agg(F.collect_list("ranks").alias("ranks")).join(copies, "doc", "full")
    blocks = suffix_blocks(with_packed(long.select("doc", "digest", "text"), "text").join(known, "doc"), max(1, -(-total // SUFFIX_BUCKET_BYTES)))
    spans = repeated_spans(blocks).groupBy("doc", "digest").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    return with_packed(texts, "text").join(spans, ["doc", "digest"], "left").select("doc_id", "text", "spans")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, stops = ([x for x in batch.column(c).to_pylist()] for c in ("starts", "stops"))
            rows = []
            for text, a, b in zip(_binary(batch, "text"), starts, stops):
                text = unpacked(text) if text else b""
                removed, runs, left = remaining(text, list(zip(a or [], b or [])))
                rows.append((len(text), removed, runs, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.record_batch(
                [batch.column("doc_id"), *[pa.array(list(c), pa.int64()) for c in columns[:3]], pa.array(list(columns[3]), pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = repeated_strings(docs).select("doc_id", "text", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))
    doc_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {doc_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

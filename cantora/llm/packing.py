"""Best-fit packing of tokenized documents into sequences, with matched large items.

What fits together depends on lengths alone, and there are no more lengths than tokens in a
sequence. So the driver packs the histogram of lengths, a table of bounded size, and each task
places its pieces by their rank among the pieces of their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import stored, tidy, with_position
from cantora.llm.tokens import encoder

CAPACITY = 2048
END = b"\0\0\0\0"  # id 0 ends a document


@dataclass(frozen=True)
class Run:
    """``count`` pieces of one length, from a rank on, ``each`` of them in consecutive places of every
    sequence from ``sequence`` on, the first at ``offset``."""

    length: int
    rank: int
    count: int
    each: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place every piece of a histogram (length: number).

    Large pieces, above a third of the capacity, are matched greedily from the longest down: each with
    the longest large one that still fits, so at most two share a sequence. Smaller pieces, longest
    first, go where the least room is left that holds them, and open sequences only where none does.
    Sequences in the same state are one range of ids; a step fills or splits a range, so the work
    depends on the number of lengths, not of pieces.
    """
    left = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(left, 0)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left: ranges (first id, number)
    open_gaps: list[int] = []  # the keys of gaps, in order
    opened = 0

    def put(length: int, count: int, each: int, sequence: int, offset: int) -> None:
        runs.append(Run(length, used[length], count, each, sequence, offset))
        used[length] += count
        left[length] -= count

    def keep(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in gaps:
                bisect.insort(open_gaps, room)
                gaps[room] = []
            gaps[room].append((first, number))

    large = [n for n in sorted(left, reverse=True) if 3 * n > capacity]
    ascending = large[::-1]
    for n in large:
        while left[n]:
            # the longest large partner that fits and is left; at most n itself
            at = bisect.bisect_right(ascending, min(capacity - n, n)) - 1
            while at >= 0 and (not left[ascending[at]] or ascending[at] == n and left[n] < 2):
                at -= 1
            if at < 0:
                number = left[n]
                put(n, number, 1, opened, 0)
                keep(capacity - n, opened, number)
            elif ascending[at] == n:
                number = left[n] // 2
                put(n, 2 * number, 2, opened, 0)
                keep(capacity - 2 * n, opened, number)
            else:
                partner = ascending[at]
                number = min(left[n], left[partner])
                put(n, number, 1, opened, 0)
                put(partner, number, 1, opened, n)
                keep(capacity - n - partner, opened, number)
            opened += number

    for n in sorted(left, reverse=True):
        while left[n]:
            at = bisect.bisect_left(open_gaps, n)
            if at == len(open_gaps):
                room, each = capacity, capacity // n
                number = -(-left[n] // each)
                first, opened = opened, opened + number
            else:
                room = open_gaps[at]
                each = room // n
                first, number = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], open_gaps[at]
            full = min(number, left[n] // each)
            if full:
                put(n, full * each, each, first, capacity - room)
                keep(room - each * n, first, full)
            rest = number - full
            if rest and left[n]:  # fewer than fill one more
                some = left[n]
                put(n, some, some, first + full, capacity - room)
                keep(room - some * n, first + full, 1)
                full, rest = full + 1, rest - 1
            keep(room, first + full, rest)
    return runs


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every row of ``docs`` (doc_id, text).

    A document is its ids and the id 0. One longer than ``capacity`` is cut from its end, so only its
    first piece may be shorter.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer).ids
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for at, text in enumerate(batch.column("text")):
                ids = ids_of(text.as_py() or "") + END
                total = len(ids) // 4
                start, end = 0, total % capacity or min(total, capacity)
                piece = 0
                while start < total:
                    rows.append((at, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
                    start, end, piece = end, end + capacity, piece + 1
            at, piece, start, length, crc = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(at, pa.int64())), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
            })

    return docs.select("doc_id", "text").mapInArrow(
        tidy(cut, lambda: encoder(tokenizer).forget()), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``.

    The texts are encoded once, in the scan; only pieces of a few numbers are shuffled, into ranges of
    (length, doc_id, piece), which split any length or document however common.

    Defined cases: a NULL or empty text is one piece, the id 0; a NULL doc_id is kept; repeated rows are
    packed each; an empty table gives no rows; further columns are ignored.
    """
    cut = stored(pieces(docs, tokenizer, capacity))
    placed = with_position(cut, ["length", "doc_id", "piece", "ids_crc32"])
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    before, start_of = 0, {}
    for n in sorted(counts):
        start_of[n], before = before, before + counts[n]
    runs = sorted(plan(counts, capacity), key=lambda r: start_of[r.length] + r.rank)
    table = np.array(
        [(start_of[r.length] + r.rank, r.each, r.sequence, r.offset, r.length) for r in runs], dtype=np.int64
    ).reshape(-1, 5)
    held = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("sequence_id long, offset long")
    def place(position: pd.Series) -> pd.DataFrame:
        starts, each, sequence, offset, length = held.value.T
        at = position.to_numpy(dtype=np.int64)
        run = np.searchsorted(starts, at, side="right") - 1
        place_in_run = at - starts[run]
        return pd.DataFrame({
            "sequence_id": sequence[run] + place_in_run // each[run],
            "offset": offset[run] + place_in_run % each[run] * length[run],
        })

    return placed.withColumn("to", place("position")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "to.sequence_id", "to.offset"
    )

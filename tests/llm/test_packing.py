import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cantora.llm import packing

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def layout(histogram, capacity):
    bins, ranks = {}, {}
    for r in packing.plan(histogram, capacity):
        ranks.setdefault(r.length, []).append((r.rank, r.count))
        for i in range(r.count):
            bins.setdefault(r.sequence + i // r.each, []).append((r.offset + i % r.each * r.length, r.length))
    return bins, ranks


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([6, 10, 50]).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 40), max_size=12))))
def test_plan_places_all_without_gaps(case):
    capacity, histogram = case
    bins, ranks = layout(histogram, capacity)
    assert {n: sum(c for _, c in r) for n, r in ranks.items()} == histogram
    for runs in ranks.values():
        end = 0
        for rank, count in sorted(runs):
            assert rank == end
            end += count
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * n > capacity for _, n in pieces) <= 2
    assert sorted(bins) == list(range(len(bins)))
    total = sum(n * c for n, c in histogram.items())
    assert len(bins) <= max(1, 2 * total / capacity + 1) or not histogram


def test_plan_is_near_the_bound():
    rng = random.Random(5)
    histogram = {}
    for _ in range(20_000):
        n = min(2048, max(1, int(rng.lognormvariate(5.5, 1))))
        histogram[n] = histogram.get(n, 0) + 1
    bins, _ = layout(histogram, 2048)
    assert len(bins) <= 1.01 * sum(n * c for n, c in histogram.items()) / 2048 + 1


def check(docs, rows, capacity):
    library = Tokenizer.from_file(BYTE)
    wanted = {}
    for doc_id, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % capacity or min(len(ids), capacity)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            key = (doc_id, p, a, b - a, zlib.crc32(ids[a:b].tobytes()))
            wanted[key] = wanted.get(key, 0) + 1
    got = {}
    bins = {}
    for r in rows:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        got[key] = got.get(key, 0) + 1
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == wanted
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity


def test_pack_odd_documents(odd_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check(docs, packing.pack(odd_docs, BYTE).collect(), 2048)
    check(docs, packing.pack(odd_docs, BYTE, capacity=16).collect(), 16)


def test_empty(no_docs):
    assert packing.pack(no_docs, BYTE).count() == 0

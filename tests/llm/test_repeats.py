import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from cantora.llm import suffix_dedup as S

DDL = "doc_id long, text string, digest string, doc int, ranks string"


def brute(rows):
    first = {}
    for doc, text in rows:
        raw, doc = (text or "").encode(), S._LAST if doc is None else doc
        for i in range(len(raw) - 49):
            w = raw[i : i + 50]
            first[w] = min(first.get(w, doc), doc)
    found = []
    for doc, text in rows:
        raw, key = (text or "").encode(), S._LAST if doc is None else doc
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < key:
                gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        found.append((doc, len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(found, key=str)


def got(df):
    return sorted(map(tuple, S.without_repeats(df).collect()), key=str)


def made(prose, seed, n=80):
    rng = random.Random(seed)
    shared = [prose(rng.randint(5, 40), 100 + i) for i in range(6)]
    rows = []
    for d in rng.sample(range(-20, 500), n):
        parts = [prose(rng.randint(0, 60), 1000 + d), rng.choice(shared), prose(rng.randint(0, 9), 2000 + d), rng.choice(shared)]
        text = rng.choice(["", "É🙂 "]) + "".join(rng.sample(parts, 4))
        rows.append((d, text))
        if rng.random() < 0.3:  # near copies
            at = rng.randrange(len(text))
            rows.append((d + 600, text[:at] + "#" + text[at + 1 :]))
        if rng.random() < 0.2:  # whole copies
            rows.append((rng.choice([d, d + 1200]), text))
    rows += [(900, "a" * 300), (901, "a" * 170 + "b" + "a" * 60), (902, "ab" * 90), (903, "ab" * 25), (904, "ab" * 24 + "a")]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (905, None), (906, ""), (905, rows[1][1])]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(frame, prose, monkeypatch, small):
    """Cut texts, many buckets and sorting a share at a time change nothing."""
    if small:
        for name, value in (("GROUP_BYTES", 256), ("_PLACE", np.uint64(255)), ("LOCAL_BYTES", 500),
                            ("RANK_BUCKET_BYTES", 4000), ("SUFFIX_BUCKET_BYTES", 1500), ("SORT_AT_ONCE", 700)):
            monkeypatch.setattr(S, name, value)
    rows = made(prose, 5 + small)
    df = frame([(*r, "x", 1, "y") for r in rows], DDL, 5)
    assert got(df) == brute(rows)


def test_strings_with_one_key_are_compared(frame, prose, monkeypatch):
    """Equal hashes of different strings remove nothing."""
    whole = S.rolled
    monkeypatch.setattr(S, "rolled", lambda v, size, tag: whole(v, size, tag) if tag == 1 else whole(v, size, tag) % np.uint64(7))
    rows = made(prose, 9, 12)
    texts = [t.encode() for _, t in rows if t]
    stretches = [t for t in texts if len(t) >= 50]
    n = np.array([len(t) - 49 for t in stretches])
    docs = np.array([i % 5 for i in range(len(n))])
    zero = np.zeros(len(n), np.int64)
    found = S.Suffixes(np.frombuffer(b"".join(stretches), np.uint8), n, zero.view(np.uint64), docs, zero, zero).settled()
    first = {}
    for t, d in zip(stretches, docs.tolist()):
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(first.get(t[i : i + 50], d), d)
    want = [first[t[i : i + 50]] < d for t, d in zip(stretches, docs.tolist()) for i in range(len(t) - 49)]
    assert found.tolist() == want


def test_a_bucket_is_sorted_in_little_memory():
    """Stretches of 65 bytes, the usual ones of a bucket: what sorting takes stays a few times their bytes."""
    rng = np.random.default_rng(3)
    m = 60_000
    buf = rng.integers(97, 123, (m // 4, 65), dtype=np.uint8)[rng.integers(0, m // 4, m)].reshape(-1)
    zero = np.zeros(m, np.int64)
    bucket = S.Suffixes(buf, np.full(m, 16), zero.view(np.uint64), np.arange(m), zero, zero)
    tracemalloc.start()
    try:
        found = bucket.settled()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert 0 < found.sum() < len(found)
    assert peak < 16 * len(buf), peak


def test_every_string_has_a_place_and_equal_strings_the_same(prose):
    text = (prose(300, 1) + prose(40, 2) + "x" + prose(40, 2)).encode()
    (_, s), = S.groups([text])
    covered = np.zeros(len(text) - 49, int)
    rank = {}
    for a, b, r in zip(s.first, s.last, s.rank):
        covered[a : b + 1] += 1
        for i in range(a, b + 1):
            assert rank.setdefault(text[i : i + 50], r) == r
    assert (covered == 1).all()


def test_packed_blocks_round_trip(prose):
    raw = np.frombuffer(prose(60, 4).encode()[:300], np.uint8)
    one = S.Suffixes(raw, np.array([150, 52]), np.array([7, 1 << 63], np.uint64), np.array([-3, S._LAST]), np.array([5, -6]), np.array([0, 9]))
    two = S.Suffixes.joined([one.pick(np.array([0])).block(), one.pick(np.array([1])).block()])
    for name in ("buf", "n", "rank", "doc", "digest", "place"):
        assert getattr(one, name).tolist() == getattr(two, name).tolist()


def test_odd_rows(odd_docs, no_docs):
    assert got(no_docs) == []
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(odd_docs) == brute(rows)

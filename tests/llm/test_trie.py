import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cantora.llm import checks, prefix_trie, queries
from tests.parity import compare, duck, duck_types, spark_types

DDL = "conv_id long, turn long, role string, text string, c long, d int, top string, path int"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c - 100 * int(c / 100))
        whole[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)

    def total(key):
        leaves, saved = (0 if children[key] else 1), (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        for child in children[key]:
            a, b = done[child]
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    done = {}
    for key in sorted(members, key=len, reverse=True):
        done[key] = total(key)
    found = []
    for key, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(whole[c]) == len(key))
        found.append((min(ms), len(key), min(members[key[:-1]]) if key else None, len(ms), len(children[key]), *done[key],
                      hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def got(df):
    return sorted(map(tuple, prefix_trie.prefix_trie(df).collect()), key=str)


def made(seed, convs=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 450), convs):
        for t in rng.sample(range(-5, 60), rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bb", "cé🙂", None, ""])))
    rows += [(c, t, "user", "same" * t) for c in range(1000, 1030) for t in range(7)]
    rows += [(1100, 0, "user", "x"), (None, 1, "user", "y"), (1205, 0, "user", "z"), (1206, None, None, "z"), (1206, 3, None, "z")]
    return rows


@pytest.mark.parametrize("band", [2, 3, 16])
def test_equals_brute_force(frame, monkeypatch, band):
    """Bands of every height, with several rounds of contraction, give the same totals."""
    monkeypatch.setattr(prefix_trie, "BAND", band)
    rows = made(band)
    assert got(frame([(*r, 1, 1, "x", 1) for r in rows], DDL, 5)) == brute(rows)


def test_long_and_common_conversations(frame, monkeypatch):
    """A long conversation spans many ranges, one node is the end of most, and its ids come in many pieces."""
    monkeypatch.setattr(prefix_trie, "BAND", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 64)
    rows = [(300, t, "user", f"t{t}") for t in range(150)] + [(350, t, "user", f"t{t}") for t in range(90)]
    rows += [(c, t, "user", "hello") for c in range(5000, 5400) for t in range(6)]
    assert got(frame([(*r, 1, 1, "x", 1) for r in rows], DDL, 6)) == brute(rows)


def test_repeated_turn_numbers_and_rows(frame):
    """Rows with the same turn number have one order, whatever order they arrive in."""
    rows = [(7, 1, "user", "a"), (7, 1, "user", "a"), (7, 1, "user", "b"), (8, 1, "user", "b"), (8, 1, "user", "a"), (8, 1, "user", "a")]
    one = got(frame([(*r, 1, 1, "x", 1) for r in rows], DDL))
    assert one == got(frame([(*r, 1, 1, "x", 1) for r in reversed(rows)], DDL))
    assert sum(r[1] == 0 for r in one) == 1


def test_empty_and_single(frame, spark):
    assert got(spark.createDataFrame([], DDL)) == []
    assert got(frame([(None, 1, "user", "x", 1, 1, "x", 1)], DDL)) == []
    rows = [(205, 1, None, None)]
    assert got(frame([(*rows[0], 1, 1, "x", 1)], DDL)) == brute(rows)


def test_query_equals_sql(spark):
    con = duck("/root/testdata/sf0.01")
    sql = checks.oracle_sql()["op11_prefix_trie"]
    df = queries.queries()["op11_prefix_trie"](spark, "/root/testdata/sf0.01")
    assert spark_types(df) == duck_types(con, sql)
    equal, message = compare(df, con, sql)
    assert equal, message

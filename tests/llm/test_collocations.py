import random
import re
from collections import Counter, defaultdict

import pytest

from cantora.llm import checks, collocations, queries
from tests.parity import compare, duck, duck_types, spark_types

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support, longest=5, top=2000, share=100):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i : i + k])] += 1
    found = []
    for lang, f in counts.items():
        wanted = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        scored = []
        for p, a in wanted.items():
            inside = (q for q in wanted if len(q) > len(p) and 100 * wanted[q] >= share * a)
            if any(q[i : i + len(p)] == p for q in inside for i in range(len(q) - len(p) + 1)):
                continue
            n = totals[lang]
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r, n))
        for rank, (s, a, p, l, r, n) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(found)


def got(df, **kw):
    return sorted(map(tuple, collocations.collocations(df, **kw).collect()))


def texts(n, seed):
    rng = random.Random(seed)
    words = ["Ab", "b", "c\x1c", "É", "ñandú", "D'x", "\0", "zz"]
    gaps = [" "] * 9 + ["  ", "\t", ". ", "\n", "\r\n", "!?"]
    return [
        (rng.choice(["en", "en", "en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40))))
        for _ in range(n)
    ]


@pytest.mark.parametrize("shard", [collocations.RUN_BYTES, 200])
def test_equals_brute_force(frame, monkeypatch, shard):
    """Shards of a few rows and cuts inside a text give the same as one shard."""
    monkeypatch.setattr(collocations, "RUN_BYTES", shard)
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 3000 if shard == 200 else collocations.BUCKET_BYTES)
    monkeypatch.setattr(collocations, "CUT_BYTES", 30 if shard == 200 else collocations.CUT_BYTES)
    rows = [*texts(300, 3), (None, None), ("en", ""), ("en", " . ,"), ("fr", "one")]
    df = frame(rows, "lang string, text string")
    for support, share in ((4, 100), (9, 60)):
        want = brute(rows, support, share=share)
        assert want and got(df, support=support, share=share) == want
    assert got(df, support=4, top=3, longest=3) == brute(rows, 4, 3, 3)


def test_phrase_spread_thinly_over_the_shards_is_found(frame, monkeypatch):
    monkeypatch.setattr(collocations, "RUN_BYTES", 100)
    rows = [("en", f"rare pair w{i} x{i} y{i} z{i}") for i in range(40)] + [("en", "hot hot hot hot hot hot " * 5)] * 20
    assert got(frame(rows, "lang string, text string", 7), support=40) == brute(rows, 40)


def test_exact_beyond_64_bits(spark):
    """The score keeps every digit where products pass 64 bits."""
    a, n, l, r = 3_000_000_000_001, 90_000_000_000_007, 3_000_000_000_003, 4_000_000_000_037
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").selectExpr(
        "(1000BD * cast(a as decimal(18, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0))) as s")
    assert row.first()["s"] == 1000 * a * n // (l * r)


def test_odd_rows(odd_docs, no_docs):
    assert got(no_docs) == []
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert got(odd_docs, support=2) == brute(rows, 2)


def test_query_equals_sql(spark):
    con = duck("/root/testdata/sf0.01")
    sql = checks.oracle_sql()["op13_collocations"]
    df = queries.queries()["op13_collocations"](spark, "/root/testdata/sf0.01")
    assert spark_types(df) == duck_types(con, sql)
    equal, message = compare(df, con, sql)
    assert equal, message

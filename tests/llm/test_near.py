import random

import numpy as np
import pytest

import corpus_pipeline
from cantora.llm import decontaminate, near_dedup


def shingles(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute(docs, percent):
    """{(doc_id, text): (set size, smallest id of the group)} by all pairs."""
    sets = [shingles(t) for _, t in docs]
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                group[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            names[find(i)] = min(doc_id, names.get(find(i), doc_id))
    return {(d, t): (len(sets[i]), names.get(find(i))) for i, (d, t) in enumerate(docs)}


def changed(text, n, rng):
    words = text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def crowd(prose):
    """Copies and near copies of a few texts, many at the border of the threshold, ids in random order."""
    rng = random.Random(9)
    texts = []
    for base in range(6):
        text = prose(rng.choice([60, 120, 300]), base)
        texts += [text, text.upper(), text] + [changed(text, rng.randint(0, 6), rng) for _ in range(40)]
    texts += [prose(rng.randint(1, 80), 100 + i) for i in range(60)] + [None, "", " \n", "one", "one", "ONE two"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("percent", [85, 80])
def test_groups_equal_brute_force(frame, crowd, percent):
    rows = near_dedup.near_duplicates(frame(crowd, "doc_id long, text string", 8), percent).collect()
    expected = brute(crowd, percent)
    assert len(rows) == len(crowd)
    texts = dict(crowd)
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == expected[(r["doc_id"], texts[r["doc_id"]])]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_prefix_pairs_lose_nothing(frame, crowd):
    """Without any hub, the prefix filter alone finds every link between different sets."""
    shingler = near_dedup.Shingler()
    sets = {shingler(t).tobytes() for _, t in crowd if t and t.split()}
    named = [(bytes([i // 256, i % 256]), bytes([i // 256, i % 256]), x) for i, x in enumerate(sorted(sets))]
    df = frame([(a, b, bytearray(x)) for a, b, x in named], "class binary, component binary, shingles binary")
    for percent in (80, 85):
        got = {frozenset(map(bytes, (r["a"], r["b"]))) for r in near_dedup.prefix_pairs(df, percent).collect()}
        arrays = {a: np.frombuffer(x, np.uint64) for a, _, x in named}
        for a in arrays:
            for b in arrays:
                if a < b and near_dedup.similar(len(np.intersect1d(arrays[a], arrays[b])), len(arrays[a]), len(arrays[b]), percent):
                    assert frozenset((a, b)) in got


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for similarity in (0.8, 0.85, 0.9, 0.95):
        dropped = 0
        for _ in range(60):
            n = 400
            common = round(2 * n * similarity / (1 + similarity))
            pool = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
            a, b = pool[:n], pool[n - common :]
            x, y = (near_dedup.odd_sketch(near_dedup.minhash(s)) for s in (a, b))
            dropped += sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) > near_dedup.most_flips(similarity)
        assert dropped == 0
    far = [near_dedup.odd_sketch(near_dedup.minhash(rng.integers(0, 2**63, 300, dtype=np.uint64))) for _ in range(2)]
    assert sum(int(v).bit_count() for v in (far[0] ^ far[1]).view(np.uint64)) > near_dedup.most_flips(0.85)


def test_odd_documents(odd_docs, no_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["component_id"], r["kept"]))
    assert len(rows) == 12 and by[5] == [(5, True)] and by[6] == [(5, False)] * 2
    assert by[None] == [(None, True)] * 2 and by[1] == by[1] and by[2] == [(2, True)] and by[8] == [(8, True)]
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_one_of_each_group(odd_docs, frame, crowd):
    kept = near_dedup.one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, None, None, 8, 9, 10]))
    heads = {g for _, g in brute(crowd, 80).values()}
    kept = near_dedup.one_of_each_group(frame(crowd, "doc_id long, text string"), 80)
    assert {r["doc_id"] for r in kept.collect()} == heads


def test_one_of_rows_that_differ_elsewhere(frame, prose):
    text = prose(40, 1)
    rows = [(1, text, "a", None), (1, text, "b", None), (1, text, "b", None), (2, text, "c", 1), (3, prose(40, 2), "d", 2)]
    schema = "doc_id long, text string, source string, n long"
    picks = [near_dedup.one_of_each_group(frame(r, schema)).collect() for r in (rows, rows[::-1])]
    assert sorted(picks[0]) == sorted(picks[1]) and sorted(r["doc_id"] for r in picks[0]) == [1, 3]


# decontamination


def template_brute(docs, items):
    """Pairs held, by windows compared token by token."""
    def tokens(text):
        t = decontaminate.Tokens()
        spaced = decontaminate._AMOUNT.sub(r"\g<0> ", text)
        kinds = t.of([text])[1].tolist()
        cores = [c for c in (decontaminate._CORE.sub("", x).lower() for x in spaced.split()) if c]
        assert len(kinds) == len(cores)
        return cores, kinds

    found = set()
    for d, text in docs:
        for item, asked in items:
            (x, kx), (y, ky) = tokens(text or ""), tokens(asked or "")
            if len(y) < decontaminate.SHORTEST:
                continue
            w = min(decontaminate.WINDOW, len(y))
            plain, slotted = set(), {}
            for i in range(len(y) - w + 1):
                for j in range(len(x) - w + 1):
                    if x[j : j + w] == y[i : i + w]:
                        plain.add(i)
                    form = lambda c, k: [a if b == 0 else b for a, b in zip(c, k)]
                    slots = sum(k > 0 for k in ky[i : i + w])
                    if slots and (w - slots) * decontaminate.WINDOW >= decontaminate.LITERAL * w and form(
                            x[j : j + w], kx[j : j + w]) == form(y[i : i + w], ky[i : i + w]):
                        slotted.setdefault(j - i, []).append(i)
            windows = set(plain)
            for shift, at in slotted.items():
                pairs = {(y[i + o], x[i + o + shift]) for i in at for o in range(w) if ky[i + o] > 0}
                if len({a for a, _ in pairs}) == len(pairs):
                    windows |= set(at)
            if len(windows) >= min(decontaminate.MATCHED, len(y) - w + 1):
                found.add((d, item, len(windows)))
    return found


ITEM = "so Anna Berg pays 12 dollars for 3 kg of the red apples and then Anna Berg walks 7 km to the old mill"


def test_contamination_equals_brute_force(frame, prose):
    rng = random.Random(3)
    items = [(1, ITEM), (2, prose(30, 50)), (3, "five short words are here"), (4, "too short"), (5, None), (2, prose(12, 51)), (None, prose(20, 52))]
    docs = [
        (1, ITEM), (2, ITEM.replace("Anna", "Paul").replace("12", "40.5").replace("km", "miles")), (3, ITEM.upper()),
        (4, ITEM.replace("Anna", "Lena", 1)), (5, ITEM.replace("apples", "pears").replace("dollars", "stones")),
        (6, f"{prose(40, 60)} {items[1][1]} {prose(40, 61)}"), (7, f"{prose(40, 62)} {' '.join(items[1][1].split()[4:18])} x"),
        (8, f"{prose(40, 62)} {' '.join(items[1][1].split()[4:14])} x"), (9, "Five short words, are here!"), (10, None), (11, ""),
        (None, items[5][1]), (12, items[6][1]), (6, f"{prose(40, 60)} {items[1][1]} {prose(40, 61)}"),
    ] + [(20 + i, prose(rng.randint(1, 60), 70 + i)) for i in range(30)]
    got = decontaminate.contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["n_matched"]) for r in got} == template_brute(docs, items)
    flagged = {r["doc_id"] for r in got}
    assert {1, 2, 3, 6, 7, 9, None, 12} <= flagged and not {8, 10, 11} & flagged
    assert {r["doc_id"]: r["templated"] for r in got}[2] and not {r["doc_id"]: r["templated"] for r in got}[1]


def test_decontaminate_cases(odd_docs, no_docs, frame, prose):
    items = frame([(1, prose(40, 3), "x")], "item_id long, text string, key string")
    kept = decontaminate.decontaminate(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == 11
    assert decontaminate.decontaminate(odd_docs, items.limit(0)).count() == 12
    assert decontaminate.decontaminate(no_docs, items).count() == 0


def test_decontamination_sorts_no_texts(spark, frame, prose):
    docs = frame([(i, prose(60, i)) for i in range(40)] + [(None, prose(60, 3)), (7, None)], "doc_id long, text string")
    items = frame([(1, prose(60, 3)), (None, prose(60, 5))], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = decontaminate.decontaminate(docs, items)
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        join = next(line for line in plan.split("\n") if "Join" in line)
        assert "ShuffledHashJoin" in join and "LeftAnti" in join
        held = {r["doc_id"] for r in decontaminate.contaminated(docs, items).collect()}
        assert {3, 5, None} <= held
        assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(i) for i in [*range(40), 7] if i not in held)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_windows_stay_inside_their_text(prose):
    texts = ["", "7 km", "km and 7 km to the mill by 12 of us", prose(30, 1), "x", prose(9, 2), " \n", "kg a b 3 kg c d e f g h"]
    tokens = decontaminate.Tokens()
    together = sorted(decontaminate.windows_of(tokens, texts, [5, 8], None))
    apart = sorted((i, *w[1:]) for i, t in enumerate(texts) for w in decontaminate.windows_of(tokens, [t], [5, 8], None))
    assert together == apart and {w[0] for w in together} == {2, 3, 5, 7}


def test_large_group_below_the_threshold_does_not_meet(frame, prose):
    """Sets of one origin, each too far from the others: no candidates, and none for a group twice as large."""
    rng = random.Random(4)
    shingler = near_dedup.Shingler()
    base = prose(200, 5)
    sets = [shingler(changed(base, 8, rng)) for _ in range(120)]
    close = [i for i in range(120) for j in range(i) if near_dedup.similar(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), 80)]
    assert not close
    rows = [(bytes([i]), bytes([i]), bytearray(x.tobytes())) for i, x in enumerate(sets)]
    schema = "class binary, component binary, shingles binary"
    assert near_dedup.prefix_pairs(frame(rows, schema), 80).count() <= 12


def test_windows_by_doubling():
    values = np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64)
    for size in range(1, 14):
        h = decontaminate.rolled(values, size, 1)
        assert len(h) == 40 - size + 1
        assert h[5] == decontaminate.rolled(values[5 : 5 + size], size, 1)[0]
        assert h[5] != decontaminate.rolled(values[5 : 5 + size], size, 0)[0]


# pipeline


def test_pipeline_stages(spark, odd_docs, no_docs, frame, tmp_path, prose):
    labels = [(i, 1, int(i % 4 == 0)) for i in range(1, 9)]
    frame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame([(1, prose(40, 3))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name == "packing":
                assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
            else:
                assert out.columns == docs.columns
            rows = out.collect()
            if not docs.limit(1).count():
                assert rows == []
            docs = spark.createDataFrame(rows, out.schema)


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100

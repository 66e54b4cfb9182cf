import numpy as np

from cantora.llm import ann


def rows_of(vectors, start=0):
    return [(start + i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]


def brute(rows, every, k):
    valid = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in valid:
        if q % every == 0:
            near = {(-float(x @ y) / (np.linalg.norm(x) * np.linalg.norm(y)), i) for i, y in valid if i != q and len(y) == len(x)}
            out[q] = sorted(near)[:k]
    return out


def test_recall_of_one_graph():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    vectors = (centres[rng.integers(0, 12, 1500)] + 0.5 * rng.normal(size=(1500, 24))).astype(np.float32)
    graph = ann.build(vectors)
    found = ann.search(graph, graph.unit[:200], 6)
    best = np.argsort(-(graph.unit[:200] @ graph.unit.T), axis=1)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(found, best)]) > 0.95


def test_query_against_brute_force(frame):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(600, 8)).astype(np.float32)
    vectors[100:300] = vectors[0]  # one common vector
    rows = rows_of(vectors) + [
        (600, None, 1), (650, [0.0] * 8, 1), (700, [1.0, None] + [0.0] * 6, 1), (750, [float("nan")] + [1.0] * 7, 1),
        (800, [float("inf")] + [1.0] * 7, 1), (850, [], 1), (None, [1.0] * 8, 1), (900, [1.0, 2.0], 1), (901, [2.0, 1.0], 1),
    ]
    rows.append(rows[50])
    df = frame(rows, "vec_id long, embedding array<float>, shard int")
    got = {}
    for r in ann.search_every(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    expected = brute(rows[:-1], 50, 5)
    assert set(got) == set(expected) and 900 in got
    right = total = 0
    for q, near in expected.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, len(near) + 1))
        right += len({m[1] for m in mine} & {i for _, i in near})
        total += len(near)
        scores = {i: -s for s, i in brute(rows[:-1], 50, 10**6)[q]} if q == 0 else {}
        assert all(abs(scores[m[1]] - m[2]) < 1e-12 for m in mine if scores)
    assert right / total >= 0.97
    assert [m[1] for m in sorted(got[0])] == [100, 101, 102, 103, 104]  # ties to the smaller id


def test_few_and_none(frame):
    few = frame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.search_every(few).collect()] == [(0, 1, 1)]
    assert ann.search_every(few.limit(1)).count() == 0
    assert ann.search_every(few.limit(0)).count() == 0


def test_several_shards(frame):
    rng = np.random.default_rng(4)
    rows = rows_of(rng.normal(size=(900, 6)).astype(np.float32))
    df = frame(rows, "vec_id long, embedding array<float>, n int").drop("n")
    index = ann.build_index(df, keep=6, shard_rows=200)
    assert index.count() == 5 and sum(r["n"] for r in index.select("n").collect()) == 900
    found = ann.nearest(df.where("vec_id % 50 = 0"), index, 5, block_rows=7).collect()
    expected = brute(rows, 50, 5)
    hits = sum(r["vec_id"] in {i for _, i in expected[r["query_id"]]} for r in found)
    assert len(found) == 90 and hits >= 88


def test_scaled_copies_are_ranked_exactly(frame):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(200, 8)).astype(np.float32)
    scales = 2.0 ** rng.permutation(np.arange(-20, 21))
    vectors[1:42] = vectors[0] * scales[:, None]  # one direction, equal scores
    near = vectors[50] + 1e-5 * rng.normal(size=(30, 8))  # near copies of another
    vectors[60:90] = near.astype(np.float32)
    rows = rows_of(vectors)
    found = ann.search_every(frame(rows, "vec_id long, embedding array<float>, n int")).collect()
    got = {q: [r["vec_id"] for r in sorted(found) if r["query_id"] == q] for q in (0, 50)}
    assert len(set(scales)) == 41 and got[0] == [1, 2, 3, 4, 5]
    assert got[50] == [i for _, i in brute(rows, 50, 5)[50]]

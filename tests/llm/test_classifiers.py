import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cantora.llm import language_id, toxicity

SF = "/root/testdata/sf0.01"


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# language identification


def test_ngrams_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = "".join(random.Random(2).choice("abcdé üñ") for _ in range(500))
    whole = np.sort(np.concatenate(list(language_id.ngram_buckets(text))))
    assert len(whole) == 500 + 499 + 498
    monkeypatch.setattr(language_id, "PIECE", 37)
    assert (np.sort(np.concatenate(list(language_id.ngram_buckets(text)))) == whole).all()


def test_posterior_equals_brute_force(frame):
    from collections import Counter

    rows = [("abab", "x"), ("abba ab", "x"), ("cdcd", "y"), ("dd c", "y"), ("cd", "y"), (None, "y"), ("ab", None), ("12", "x")]
    model = language_id.train(frame(rows, "text string, lang string"))
    assert model.languages == ("x", "y")
    for text in ("ab", "dcab", "c"):
        logs = []
        for lang in model.languages:
            own = [t for t, g in rows if g == lang and t and any(map(str.isalpha, t))]
            log = np.log(len(own) / 5)
            for o in range(3):
                seen = Counter(b for t in own for p in language_id.ngram_buckets(t) for b in p.tolist() if b // language_id.BUCKETS == o)
                total = sum(seen.values()) + language_id.BUCKETS
                log += sum(
                    np.log((seen[b] + 1) / total)
                    for p in language_id.ngram_buckets(text) for b in p.tolist() if b // language_id.BUCKETS == o
                )
            logs.append(log)
        p = np.exp(np.array(logs) - max(logs))
        lang, score = model.predict(text)
        assert lang == model.languages[int(np.argmax(logs))]
        assert score == pytest.approx(p.max() / p.sum(), rel=1e-4)


def test_language_cases(odd_docs, no_docs, frame):
    rows = language_id.identify(odd_docs).collect()
    texts = odd_docs.collect()
    assert len(rows) == 12
    silent = {r["doc_id"] for r in texts if r["text"] is None or not any(map(str.isalpha, r["text"]))} - {None}
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and crc(r["doc_id"], 4) == 2)
        if r["doc_id"] in silent:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert language_id.identify(no_docs).count() == 0
    unlabelled = frame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language_id.identify(unlabelled).first()["lang_pred"] == "und"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98


def test_prediction_ignores_lang(spark, odd_docs):
    from pyspark.sql import functions as F

    model = language_id.train(odd_docs)
    a = language_id.identify(odd_docs, model).select("doc_id", "lang_pred", "score").collect()
    b = language_id.identify(odd_docs.withColumn("lang", F.lit("zz")), model).select("doc_id", "lang_pred", "score").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


# toxicity


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.2
    on1, on0 = np.array([0.6, 0.5, 0.4, 0.3]), np.array([0.02, 0.02, 0.05, 0.05])
    fired = rng.random((4000, 4)) < np.where(truth[:, None], on1, on0)
    fired = np.c_[fired, fired[:, 0], fired[:, 0]]  # two copies of a voter must not count thrice
    votes = [np.flatnonzero(f).tolist() for f in fired]
    noisy = np.where(rng.random(4000) < 0.05, ~truth, truth).astype(int)
    q = toxicity.label_model(votes, noisy, 6)
    assert np.mean((q > 0.5) == truth) >= np.mean(noisy == truth)
    rows = np.repeat(np.arange(4000), [len(v) for v in votes])
    cols = np.array([j for v in votes for j in v])
    tied = toxicity.correlations(rows, cols, np.ones(4000), np.bincount(cols, minlength=6) / 4000)
    assert tied[0, 4] > 0.99 and abs(tied[2, 3]) < 0.5


def test_trust_equals_the_matrix(monkeypatch):
    rng = np.random.default_rng(6)
    fired = rng.random((500, 7)) < 0.3
    fired[:, 3] = fired[:, 0] | (rng.random(500) < 0.1)
    one = np.arange(500) % 3 == 0
    dense = np.maximum(np.corrcoef(fired[one].T), np.corrcoef(fired[~one].T))
    np.fill_diagonal(dense, 0)
    rows, cols = np.nonzero(fired)
    monkeypatch.setattr(toxicity, "BLOCK", 3)
    trust = toxicity.trust_of(rows, cols, one.astype(float), fired[one].mean(axis=0), fired[~one].mean(axis=0))
    assert np.allclose(trust, 1 / (1 + np.clip(dense - 0.1, 0, 1).sum(axis=1)), atol=1e-6) and trust[0] < 0.7


def test_voters_equal_a_recount(frame):
    import math

    rng = np.random.default_rng(8)
    words = [f"{a}{b}" for a in ("stone", "vile", "harbour", "grub", "lantern") for b in ("", "s", "er", "ing", "ly")]
    texts = {i: [*rng.choice(words, 12), *(rng.choice(["vile", "viler", "grubs"], 2) if i % 9 == 0 else [])] for i in range(400)}
    docs = frame([(i, " ".join(t) + ".") for i, t in texts.items()] + [(4, "zzz other text of a known id"), (7, None)], "doc_id long, text string")
    labels = frame([(i, int(i % 9 == 0)) for i in range(400)] + [(9, 0)], "doc_id long, toxic int")
    taught = {i: " ".join(t) + "." for i, t in texts.items() if crc(i, 5)}
    held = {i: {e for w in t.split() for e in toxicity.entries_of(w)} for i, t in taught.items()}
    toxic = sum(i % 9 == 0 for i in held)
    share = toxic / len(held)
    expected = set()
    for e in set().union(*held.values()):
        on, off = (sum(e in x for i, x in held.items() if (i % 9 == 0) == c) for c in (True, False))
        if on >= toxicity.SUPPORT and on * (len(held) - toxic) >= toxicity.LIFT * off * toxic:
            gain = on * math.log(on / ((on + off) * share)) + (off * math.log(off / ((on + off) * (1 - share))) if off else 0)
            if gain >= toxicity.GAIN:
                expected.add(e)
    voters = set(toxicity.train(docs, labels).voters)
    assert {v for v in voters if v[0] != "#"} == expected


def test_an_id_on_many_rows_teaches_once(frame):
    docs = frame([(1, f"text {i}") for i in range(50)] + [(2, "a b"), (3, "c d")], "doc_id long, text string")
    labels = frame([(i, int(i == 1)) for i in (1, 2, 3)], "doc_id long, toxic int")
    assert len(toxicity.train(docs, labels).voters) == len(toxicity.PATTERNS)
    assert toxicity.toxicity(docs, labels).count() == 52


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    scores = np.array([r["score"] for r in rows])
    toxic = np.array([r["toxic"] for r in rows]) == 1
    assert np.mean([a > b for a in scores[toxic] for b in scores[~toxic]]) > 0.9
    assert np.mean(scores[~toxic] < 0.5) > 0.98


def test_toxicity_cases(odd_docs, no_docs, frame):
    labels = frame([(i, 1, i % 2) for i in range(1, 11)] + [(5, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(odd_docs, labels).collect()
    assert len(rows) == 12
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and crc(r["doc_id"], 5) == 0) for r in rows)
    silence = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(silence) == 1
    assert toxicity.toxicity(no_docs, labels).count() == 0
    none = labels.where("doc_id < 0")
    assert all(r["score"] < 0.01 for r in toxicity.toxicity(odd_docs, none).collect())


def test_fit_never_sees_held_out_labels(frame):
    rows = [(i, f"fine words here {'scum' if crc(i, 5) == 0 else ''}") for i in range(200)]
    docs = frame(rows, "doc_id long, text string")
    labels = frame([(i, int(crc(i, 5) == 0 or i % 7 == 0)) for i in range(200)], "doc_id long, toxic int")
    assert "scum" not in toxicity.train(docs, labels).voters


def test_scoring_keeps_no_words_when_a_task_ends(frame, monkeypatch):
    scorer = toxicity.Scorer({"bad": 0}, np.array([2.0]), -1.0)
    docs, made = frame([(1, "a bad day")], "doc_id long, text string"), []
    monkeypatch.setattr(toxicity.F, "arrow_udf", lambda kind: lambda f: made.append(f) or (lambda c: c))
    toxicity.score_column(docs, scorer)
    scores = [s.as_py() for batch in made[0](iter([pa.array(["a bad day", None]), pa.array(["fine"])])) for s in batch]
    monkeypatch.undo()
    assert scores == [scorer.score("a bad day"), scorer.score(None), scorer.score("fine")]
    scorer.forget()
    list(made[0](iter([pa.array(["a bad day"])])))
    assert not scorer._known

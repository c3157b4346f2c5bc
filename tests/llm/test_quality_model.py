import math
import random
import time
import zlib

import numpy as np

from tessera.llm import quality_model as m
from tests.llm.samples import documents, frame, text


def fixture():
    rng = random.Random(2)
    prose = ["rain", "fell", "on", "the", "old", "bridge", "while", "a", "river", "rose", "slowly,", "and", "nobody", "came."]
    docs, labels = documents(), []
    for k in range(300):
        i = 1000 + k
        good = k % 3 != 0
        body = text(rng, 60, prose)
        docs.append((i, body if good else " ".join(w + rng.choice(["###", "***", "%%%"]) for w in body.split()), "en", 1, "x", 2.5))
        labels.append((i, int(good), 0))
    labels += [(1000, 0, 0), (None, 1, 0), (5, None, 0), (6, 7, 0), (99999, 1, 0)]
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = fixture()
    df, lab = frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = m.train(df, lab)
    got = m.score(df, model).collect()
    assert len(got) == len(docs)
    truth = {i: y for i, y, _ in labels if y in (0, 1) and i}
    for r in got:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in truth and r.doc_id >= 1000:
            assert r.predicted == truth[r.doc_id]
    kept = m.accept(df, model)
    assert kept.columns == ["doc_id", "text", "lang", "row", "fp", "part"]
    key = lambda i: (i is not None, i)
    assert sorted((r.doc_id for r in kept.collect()), key=key) == sorted((r.doc_id for r in got if r.predicted), key=key)


def test_without_labels_everything_is_accepted(spark):
    docs, labels = fixture()
    df = frame(spark, docs)
    model = m.train(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").where("quality = 1"))
    assert {(r.score, r.predicted) for r in m.score(df, model).collect()} == {(0.5, 1)}
    assert m.accept(df, model).count() == len(docs)
    assert m.score(df.where("false"), model).collect() == []


def test_ranking_recovers_the_order_of_a_linear_score():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = (x @ np.array([2.0, -1.0, 0.0, 0.5]) > 0.3).astype(int)
    model = m.fit(x[:1000], y[:1000])
    assert ((model.scores(x[1000:]) >= model.threshold) == y[1000:]).mean() > 0.98
    assert 0.29 < float(model.scores(np.array([np.linalg.lstsq(model.weights[None], np.array([model.cut]), rcond=None)[0]])).squeeze()) < 0.31


def plain_features(t):
    """The hashed shares, by dictionaries."""
    raw = (t or "").encode()
    words, out = raw.split(), {}
    for w in words:
        k = m.N_COUNTS + zlib.crc32(w) % 256
        out[k] = out.get(k, 0) + 1 / len(words)
    grams = [(a * 65536 + b * 256 + c) * 2654435761 % 2**32 >> 24 for a, b, c in zip(raw, raw[1:], raw[2:])] if words else []
    for g in grams:
        k = m.N_COUNTS + 256 + g
        out[k] = out.get(k, 0) + 1 / len(grams)
    return {k: 0.3 * math.sqrt(v) for k, v in out.items()}


def test_features_by_brute_force():
    for _, t, *_ in documents():
        got = m.features(t)
        want = plain_features(t)
        assert len(got) == m.N_FEATURES and np.isfinite(got).all() and got[m.N_COUNTS - 1] == (not (t or "").split())
        assert {k: round(v, 9) for k, v in enumerate(got.tolist()) if k >= m.N_COUNTS and v} == {k: round(v, 9) for k, v in want.items()}


def test_fit_is_the_minimum_of_the_loss_by_plain_descent():
    """Weights against gradient descent in plain Python over the same pairs; cut and score against their definitions."""
    rng = np.random.default_rng(1)
    x = rng.random((40, 3))
    y = (x[:, 0] + 0.3 * rng.random(40) > 0.6).astype(int)
    model = m.fit(x, y, pairs=300, penalty=0.05, seed=4)
    pick = np.random.default_rng(4)
    good, bad = x[y == 1].tolist(), x[y == 0].tolist()
    a, b = pick.integers(0, len(good), 300).tolist(), pick.integers(0, len(bad), 300).tolist()
    d = [[p - q for p, q in zip(good[i], bad[j])] for i, j in zip(a, b)]
    w = [0.0, 0.0, 0.0]
    for _ in range(3000):
        slope = [0.05 * v for v in w]
        for row in d:
            miss = 1 / (1 + math.exp(sum(p * q for p, q in zip(w, row)))) / len(d)
            slope = [s - miss * r for s, r in zip(slope, row)]
        w = [p - s for p, s in zip(w, slope)]
    assert np.allclose(w, model.weights, atol=1e-3)
    scores = sorted(zip((x @ model.weights).tolist(), y.tolist()))
    best = max(range(len(scores)), key=lambda k: sum(not c for _, c in scores[: k + 1]) / len(bad) + sum(c for _, c in scores[k + 1 :]) / len(good))
    assert abs(model.cut - (scores[best][0] + scores[best + 1][0]) / 2) < 1e-9
    z = model.slope * (float(x[0] @ model.weights) - model.cut) + math.log(0.3 / 0.7)
    assert abs(1 / (1 + math.exp(-z)) - float(model.scores(x[:1])[0])) < 1e-12


def test_words_alone_can_tell_classes_apart(spark):
    """Classes that differ in nothing but their words: signs, lengths and repeats are drawn alike."""
    rng = random.Random(3)
    common, kinds = [f"w{k}" for k in range(60)], (["cheap", "casino", "winner"], ["essay", "river", "method"])
    rows, labels = [], []
    for k in range(400):
        rows.append((k, " ".join(rng.choice(common if rng.random() < 0.8 else kinds[k % 2]) for _ in range(80)), "en", 1, "x", 2.5))
        labels.append((k, k % 2, 0))
    model = m.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = [r for r in m.score(frame(spark, rows), model).collect() if r.held_out]
    assert len(got) > 40 and sum(r.predicted == r.doc_id % 2 for r in got) >= 0.95 * len(got)


def test_a_very_long_text_takes_time_in_proportion():
    began = time.time()
    assert np.isfinite(m.features("some words of a long text, and more! " * 100_000)).all() and time.time() - began < 5


def test_fit_of_all_pairs_is_the_minimum_of_their_loss():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 3)) * 4
    y = (x[:, 0] + rng.normal(size=60) > 2).astype(int)
    d = (x[y == 1][:, None] - x[y == 0]).reshape(-1, 3)
    w = m.fit(x, y).weights
    assert np.abs(3e-3 * w - (d / (1 + np.exp(d @ w))[:, None]).mean(axis=0)).max() < 1e-8


def test_all_labelled_documents_teach(spark):
    """Beyond any sample's size: the model is that of all rows, and what only a few of them show is learnt."""
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(4000):
        good = k % 8 != 0
        mark = [] if good else ["zzz"] if k % 400 == 0 else ["###", "***"]
        rows.append((k, " ".join([rng.choice(["rain", "river", "lamp", "stone"]) for _ in range(12)] + mark), "en", 1, "x", 2.5))
        labels.append((k, int(good), 0))
    rows += [(7, "another text of the same id", "en", 1, "x", 2.5), (11, rows[11][1], "en", 1, "x", 2.5)]
    got = m.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    teach = {i: y for i, y, _ in labels if zlib.crc32(str(i).encode()) % 5}
    least = {}
    for i, t, *_ in rows:
        if i in teach:
            least[i] = min(least.get(i, b"\xff"), m.features(t).tobytes())
    assert len(least) > 3000
    want = m.fit(np.array([np.frombuffer(least[i]) for i in sorted(least)]), np.array([teach[i] for i in sorted(least)]))
    assert np.abs(got.weights - want.weights).max() < 2e-9 and abs(got.cut - want.cut) < 1e-6 and abs(got.slope / want.slope - 1) < 1e-6
    assert got.threshold == want.threshold == 0.3

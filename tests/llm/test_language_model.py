import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import language_model as lm
from tests.llm.samples import documents, frame


def tokens(text):
    raw = (text or "").encode().lower()
    return [w for w in raw.translate(bytes(32 if 9 <= b <= 13 else b for b in range(256))).split(b" ") if w] + [None]


def plain(rows, k2=500.0, k3=5.0):
    """The formula, not the automaton: counts of whole n-grams as tuples."""
    kept = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1
    c = Counter()
    for i, t, *_ in rows:
        if kept(i):
            w = [None, *tokens(t)]
            c.update((x,) for x in w[1:])
            c.update(zip(w, w[1:]))
            c.update(zip(w, w[1:], w[2:]))
    ones = {g[0]: n for g, n in c.items() if len(g) == 1}
    n, v = sum(ones.values()), len(ones)
    c1, c2 = (sum(x == y for x in ones.values()) for y in (1, 2))
    d = c1 / (c1 + 2 * c2) if c1 and c2 else 0.5
    p1 = lambda w: ((ones[w] - d) / n if w in ones else d * v / n) if n else 1.0
    p2 = lambda h, w: (c[h, w] + k2 * p1(w)) / (c[h,] + k2)
    p3 = lambda g, h, w: (c[g, h, w] + k3 * p2(h, w)) / (c[g, h] + k3)
    out = []
    for i, t, *_ in rows:
        w = [None, *tokens(t)]
        base = sum(math.log10((ones.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w[1:])
        score = math.log10(p2(None, w[1])) + sum(math.log10(p3(*g)) for g in zip(w, w[1:], w[2:]))
        out.append((i, not kept(i), len(w) - 1, sum(x in ones for x in w[1:]), n, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0], round(r[5], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("size", [lm.CHUNK_TOKENS, 500])
def test_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", size)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 4096)
    rows = documents()
    got = lm.log_probabilities(frame(spark, rows)).collect()
    same(got, plain(rows))


def chunk(texts, trains):
    ids = np.array([w for t in texts for w in t])
    docs = np.array([(k, 0, kept, len(t)) for k, (t, kept) in enumerate(zip(texts, trains))])
    return lm.Chunk(docs.astype(np.int64).tobytes(), lm._squeezed(ids), lm._shortened(np.arange(100, 100 + ids.max() + 1, dtype=np.uint64))).with_triples()


class Walk:
    """The automaton as it is drawn: dictionaries of arcs, one state at a time."""

    def __init__(self, corpus, size, k2, k3, d):
        c = Counter()
        for t in corpus:
            c.update((w,) for w in t)
            c.update(zip([0, *t], t))
            c.update(zip([0, *t], t, t[1:]))
        n, v = sum(x for g, x in c.items() if len(g) == 1), sum(len(g) == 1 for g in c)
        p1 = lambda w: (c[w,] - d) / n if c[w,] else d * v / n
        p2 = lambda h, w: (c[h, w] + k2 * p1(w)) / (c[h,] + k2)
        known = lambda *g: () if not g else g if c[g] else known(*g[1:])
        self.start = known(0)
        self.arcs = {((), w): (p1(w), known(w)) for w in range(size)}
        for g in c:
            if len(g) == 2:
                self.arcs[g[:1], g[1]] = (p2(*g), known(0) if g[1] == 0 else g)
            if len(g) == 3:
                self.arcs[g[:2], g[2]] = ((c[g] + k3 * p2(*g[1:])) / (c[g[:2]] + k3), known(0) if g[2] == 0 else g[1:])
        self.failure = {g: (k2 / (c[g] + k2) if len(g) == 1 else k3 / (c[g] + k3), known(*g[1:])) for g in c if len(g) < 3}

    def read(self, text, state=None):
        state, total, states = self.start if state is None else state, 1.0, []
        for w in text:
            states.append(state)
            while (state, w) not in self.arcs:
                weight, state = self.failure[state]
                total *= weight
            weight, state = self.arcs[state, w]
            total *= weight
        return total, states


def test_paths_are_those_of_the_automaton():
    rng = random.Random(4)
    texts = [[rng.randrange(1, 9) for _ in range(rng.randrange(12))] + [0] for _ in range(60)]
    trains = [k % 4 > 0 for k in range(60)]
    c = chunk(texts, trains)
    size = len(c.words)
    n, v = int(c.ones.sum()), int((c.ones > 0).sum())
    walk = Walk([t for t, kept in zip(texts, trains) if kept], size, 2.0, 1.5, 0.6)
    a = lm.Automaton(c, (c.ones, c.twos, c.threes), {"n": n, "v": v, "discount": 0.6}, (2.0, 1.5))
    assert np.allclose(10 ** a.read(c), [walk.read(t)[0] for t in texts], rtol=1e-9)
    # The states carried are the longest known histories, and failure arcs lead to shorter ones.
    named = lambda s: () if s == 0 else (s - 1,) if s <= size else divmod(int(c.pairs[s - 1 - size]), size)
    states = np.concatenate([[a.start], a.target[c.pair[:-1]]])
    states[c.starts] = a.start
    assert [named(int(s)) for s in states] == [s for t in texts for s in walk.read(t)[1]]
    assert {len(named(int(s))) for s in states} == {1, 2}
    for s in set(states.tolist()):
        assert named(int(a.failure[s])) == walk.failure[named(s)][1] and abs(10 ** a.failure_weight[s] - walk.failure[named(s)][0]) < 1e-12


def test_probabilities_sum_to_one_in_every_state():
    """Over all words after each history, the unknown word once."""
    walk = Walk([[1, 2, 3, 0], [1, 0], [1, 0], [2, 3, 1, 0]], 5, 2.0, 1.5, 0.6)
    for state in [(), *(g for g in walk.failure if len(g) == 1 or g[1])]:
        assert abs(sum(walk.read([w], state)[0] for w in range(5)) - 1) < 1e-9


def test_numbers_and_hashes_come_back():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 100_000, 5000)
    assert (lm._unsqueezed(lm._squeezed(ids), 5000) == ids).all() and lm._unsqueezed(lm._squeezed(ids[:0]), 0).size == 0
    words = rng.integers(0, 2**63, 50).astype(np.uint64)
    assert (lm._lengthened(lm._shortened(words)) == words & np.uint64(2**48 - 1)).all()
    hashes = rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2)
    order, bounds = lm._by_bucket(hashes, 7)
    for b in range(7):
        mine = hashes[order[bounds[b] : bounds[b + 1]]]
        assert (lm._unpacked(lm._packed(mine)).astype(np.uint64) == (mine & np.uint64(2**40 - 1))).all() and len(mine) > 300


def test_chunks_and_buckets_do_not_matter(spark, monkeypatch):
    rows = documents()
    key = lambda r: (r.doc_id or -1, r.n_tokens, r.score)
    found = []
    for tokens_, bytes_ in ((10**6, 1 << 24), (100, 1 << 24), (300, 512)):
        monkeypatch.setattr(lm, "CHUNK_TOKENS", tokens_)
        monkeypatch.setattr(lm, "BUCKET_BYTES", bytes_)
        found.append(sorted(lm.log_probabilities(frame(spark, rows)).collect(), key=key))
    assert found[0] == found[1] == found[2]


def test_no_training_rows_and_empty_table(spark):
    held = [(i, "a b", "en", 1, "x", 1.0) for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    same(lm.log_probabilities(frame(spark, held)).collect(), plain(held))
    assert lm.log_probabilities(frame(spark, held).where("false")).collect() == []

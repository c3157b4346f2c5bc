import random

import numpy as np
import xxhash

from tessera.llm import simhash
from tests.llm.samples import documents, frame


def plain_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({k: " " for k in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=4):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= distance and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    return label


def test_against_brute_force(spark):
    rows = documents()
    rng = random.Random(1)
    base = next(r[1] for r in rows if r[0] == 105)
    for k in range(12):  # near copies: a word changed in a long text
        words = base.split()
        words[rng.randrange(len(words))] = f"changed{k}"
        rows.append((200 + k, " ".join(words), "en", 1, "x", 2.5))
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    prints = [plain_print(r[1]) for r in rows]
    labels = plain_components(prints)
    least = {}
    for r, c in zip(rows, labels):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = [(r[0], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, labels)]
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    left = simhash.deduplicate(frame(spark, rows), width=0)
    assert left.columns == ["doc_id", "text", "lang", "row", "fp", "part"]
    kept = left.collect()
    assert len(kept) == len(set(labels)) and {r.doc_id for r in kept} == {least.get(c) for c in labels}


def test_links_of_dense_and_sparse_prints(spark):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 2**63))
    values = {centre}
    for _ in range(400):  # one dense group
        v = centre
        for b in rng.choice(64, 3, replace=False).tolist():
            v ^= 1 << b
        values.add(v)
    chain = int(rng.integers(0, 2**63))
    for k in range(12):  # a chain of steps of four bits
        for b in range(4):
            chain ^= 1 << (4 * k + b)
        values.add(chain)
    values |= {int(v) for v in rng.integers(0, 2**63, 300)}
    ordered = sorted(values, key=lambda v: v - ((v >> 63) << 64))
    signed = [v - ((v >> 63) << 64) for v in ordered]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.links(df)
    assert edges.count() < 15 * len(values)
    got = {r.node: r.label for r in simhash.components(edges).collect()}
    labels = plain_components(ordered)
    assert [got.get(v, v) for v in signed] == [signed[k] for k in labels]


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, documents()).where("false")).collect() == []
    assert simhash.deduplicate(frame(spark, documents()).where("false")).collect() == []


def shingles(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def test_similar_texts_leave_one_of_each_group(spark):
    """Copies with every twentieth word or so changed go; texts that share a passage stay."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, group = [], {}
    passage = [word() for _ in range(60)]
    for g in range(25):
        base = [word() for _ in range(150)]
        if g % 3 == 0:
            base = base[:90] + passage
        for k in range(4):
            text = list(base)
            for at in rng.sample(range(150), 3 * (k > 0)):
                text[at] = word()
            i = 10 * g + k
            rows.append((i, " ".join(text), "en", 1, "x", 2.5))
            group[i] = g
    for a in rows:
        for b in rows:
            s, t = shingles(a[1]), shingles(b[1])
            j = len(s & t) / len(s | t)
            assert (j >= 0.8) == (a[0] == b[0] or group[a[0]] == group[b[0]]) or group[a[0]] == group[b[0]] and j > 0.6
    kept = [r.doc_id for r in simhash.deduplicate(frame(spark, rows)).collect()]
    # The copies' similarity to the first is 0.81 and below 0.7 among themselves.
    assert set(kept) == {10 * g for g in range(25)}


def test_share_of_differing_bits_follows_similarity():
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    near, far = list(base), list(base)
    for at in rng.sample(range(400), 8):
        near[at] = "x"
    for at in rng.sample(range(400), 120):
        far[at] = "y"
    bits = lambda a, b: sum((p ^ q).bit_count() if p ^ q >= 0 else ((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(a, b))
    f = [simhash.wide_fingerprint(" ".join(t)) for t in (base, near, far)]
    assert len(f[0]) == 8 and bits(f[0], f[0]) == 0 and bits(f[0], f[1]) < 102 < bits(f[0], f[2]) and simhash.wide_fingerprint(None) == [0] * 8


def test_walk_connects_what_labels_do_not():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, (3, 2)).astype(np.uint64)
    x, y, group = [], [], []
    for g, (p, q) in enumerate(centres):
        for _ in range(40):
            flip = np.uint64(0)
            for b in rng.choice(64, 4, replace=False).tolist():
                flip |= np.uint64(1) << np.uint64(b)
            x.append(p ^ flip)
            y.append(q)
            group.append(g)
    order = rng.permutation(len(x))
    x, y, group = np.array(x, np.uint64)[order], np.array(y, np.uint64)[order], np.array(group)[order]
    for label in (np.arange(len(x)), np.where(group == 0, -1, np.arange(len(x))), np.full(len(x), 7)):
        a, b = simhash._nearest_walk(x, y, label, 20)
        root = {int(v): int(v) for v in set(label.tolist())}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for i, j in zip(a.tolist(), b.tolist()):
            assert label[i] != label[j] and group[i] == group[j]
            root[find(int(label[i]))] = find(int(label[j]))
        for g in range(3):
            assert len({find(int(v)) for v in label[group == g].tolist()}) == 1


def test_doubtful_links_are_settled_by_shingles(spark):
    words = [f"w{k}" for k in range(100)]
    texts = {1: words, 2: ["x", *words[1:]], 3: words[:60] + [f"z{k}" for k in range(40)], 4: None}
    frame_ = spark.createDataFrame([(k, t and " ".join(t)) for k, t in texts.items()], "node long, text string")
    pairs = spark.createDataFrame([(1, 2, 0.15), (1, 3, 0.15), (2, 3, 0.05), (1, 4, 0.2)], "a long, b long, share double")
    assert sorted(map(tuple, simhash.similar(pairs, frame_, 0.8, 5).collect())) == [(1, 2), (2, 3)]
    assert simhash.similar(pairs.where("false"), frame_, 0.8, 5).collect() == []


def test_links_just_under_the_bound_are_looked_at(spark):
    words = [f"w{k}" for k in range(100)]
    texts = [(1, " ".join(words)), (2, " ".join(w if k % 33 else "x" for k, w in enumerate(words)))]
    pairs = spark.createDataFrame([(1, 2, 0.105)], "a long, b long, share double")
    assert len(shingles(texts[0][1]) & shingles(texts[1][1])) / len(shingles(texts[0][1]) | shingles(texts[1][1])) < 0.8
    assert simhash.similar(pairs, spark.createDataFrame(texts, "node long, text string"), 0.8, 5).collect() == []


def plain_kept(rows, least=0.8):
    """Ids left of texts linked by similarity or one 64-bit fingerprint: the first of each component."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    place = {g: k for k, g in enumerate(sorted(set().union(*sets)))}
    has = np.zeros((len(rows), len(place)), np.float32)
    for k, s in enumerate(sets):
        has[k, [place[g] for g in s]] = 1
    both, size = has @ has.T, has.sum(axis=1)

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    prints = np.array([simhash.fingerprint(r[1]) for r in rows], np.uint64)
    for i, j in np.argwhere((both >= least * (size[:, None] + size - both) - 1e-3) | (prints[:, None] == prints)).tolist():
        label[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def test_pairs_within_a_large_family_are_found(spark):
    """A family below the bound to each other, with planted pairs above it: each pair leaves one, the others stay."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(240)]
    rows = []
    for k in range(1050):
        text = list(base)
        for at in range(0, 240, 60):
            text[at + rng.randrange(5, 55)] = word()
        rows.append([k, text])
    for k in range(60):
        text = list(rows[k * 7][1])
        for at in rng.sample(range(0, 240, 10), 3 + k % 3):
            text[at] = word()
        rows.append([2000 + k, text])
    rows = [(i, " ".join(t), "en", 1, "x", 2.5) for i, t in rows]
    want = plain_kept(rows)
    got = [r.doc_id for r in simhash.deduplicate(frame(spark, rows), distance=0, blocks=1).collect()]
    assert len(got) == len(want) and set(got) == want


def test_lone_pairs_at_the_bound_are_found(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for k in range(600):
        base = [word() for _ in range(rng.choice((24, 94, 184, 229)))]
        n = len(base) - 4
        near = list(base)
        for at in range(7, 7 + 10 * (n // 45) * (1 + (k % 3 == 0)), 10):  # five shingles each: 8 in 10 of all, or fewer
            near[at] = word()
        rows += [(2 * k, " ".join(base), "en", 1, "x", 2.5), (2 * k + 1, " ".join(near), "en", 1, "x", 2.5)]
    sets = [shingles(r[1]) for r in rows]
    share = [len(p & q) / len(p | q) for p, q in zip(sets[::2], sets[1::2])]
    want = {r[0] for r, s in zip(rows, [s for s in share for _ in range(2)]) if r[0] % 2 == 0 or s < 0.8}
    assert sum(0.8 <= s < 0.82 for s in share) > 200 and sum(s < 0.8 for s in share) > 100
    got = [r.doc_id for r in simhash.deduplicate(frame(spark, rows)).collect()]
    assert len(got) == len(want) and set(got) == want


def test_bands_of_similar_sets_meet():
    """Of pairs at 0.8 one in 13,000 shares no band; unlike ones share one rarely."""
    rng = np.random.default_rng(7)
    met, apart = 0, 0
    for _ in range(2000):
        n = int(rng.integers(5, 400))
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        gone = n // 9
        p, q = np.sort(base), np.sort(np.concatenate([base[gone:], rng.integers(0, 2**63, gone).astype(np.uint64)]))
        assert len(np.intersect1d(p, q)) >= 0.79 * len(np.union1d(p, q))
        met += not set(simhash.band_keys(p)).isdisjoint(simhash.band_keys(q))
        q = np.sort(np.concatenate([base[: n // 4], rng.integers(0, 2**63, n - n // 4).astype(np.uint64)]))
        apart += set(simhash.band_keys(p)).isdisjoint(simhash.band_keys(q))
    assert met >= 1997 and apart >= 1900 and simhash.band_keys(np.empty(0, np.uint64)) == []


def test_pairs_of_a_key_are_all_compared():
    """No run is too long: a hub with texts that are near each other and far from it."""
    rng = np.random.default_rng(4)
    pairs = lambda label, n, x, y: {(min(i, j), max(i, j)) for i, others, _ in simhash._run_pairs(label, np.full(n, 100), x, y, 0.8) for j in others.tolist()}
    for n in (3, 17, 400):
        x, y = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
        x[2], y[2] = x[1] ^ np.uint64(15), y[1]  # a pair four bits apart
        x[0], y[0] = x[1] ^ np.uint64(2**28 - 1 << 20), y[1]  # a hub 28 bits from both
        assert {(0, 1), (0, 2), (1, 2)} <= pairs(np.arange(n), n, x, y)
        got = pairs(np.minimum(np.arange(n), 1), n, x, y)
        assert {(0, 1), (0, 2)} <= got and (1, 2) not in got


def test_split_runs_meet(monkeypatch):
    monkeypatch.setattr(simhash, "_GROUP", 10)
    for n in (3, 10, 11, 57):
        parts = dict(simhash._parts(n, np.arange(n)))
        assert all(len(p) <= 20 for p in parts.values())
        assert {(i, j) for p in parts.values() for i in p.tolist() for j in p.tolist()} == {(i, j) for i in range(n) for j in range(n)}


def test_links_of_a_group_connect_what_is_similar():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = int(rng.integers(2, 25))
        pool = rng.integers(-(2**63), 2**63, 60)
        sets = [np.sort(rng.choice(pool[: int(rng.integers(30, 60))], int(rng.integers(20, 30)), replace=False)) for _ in range(n)]
        sets = [sets[int(rng.integers(0, k + 1))] if rng.random() < 0.3 else s for k, s in enumerate(sets)]
        label = rng.integers(0, n, n)

        def joined(pairs):
            of = label.tolist()
            for i, j in pairs:
                of = [of[i] if v == of[j] else v for v in of]
            return [of.index(v) for v in of]

        close = [(i, j) for i in range(n) for j in range(n) if len(np.intersect1d(sets[i], sets[j])) >= 0.5 * len(np.union1d(sets[i], sets[j])) - 1e-9]
        got = simhash._group_links(label, sets, 0.5)
        assert joined(got) == joined(close) and len(got) < len(set(label.tolist())) and set(got) <= set(close)


def test_more_blocks_find_the_same_links(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-(2**63), 2**63, 300)
    near = [int(v) ^ sum(1 << int(b) for b in rng.choice(62, int(rng.integers(1, 5)), replace=False)) for v in base]
    df = spark.createDataFrame([(int(v),) for v in base] + [(v,) for v in near], "fp long").distinct()
    found = [{(r.fp, r.label) for r in simhash.classes(df, 4, blocks).collect()} for blocks in (6, 7, 8)]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 600
    assert simhash._blocks_for(df, 4) == 6


def test_families_of_like_texts_keep_their_brute_force_components(spark):
    """Recall and precision over groups around 0.8, of sizes from 2 to 40 and texts from 20 to 900 words."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    rows = []
    for _ in range(60):
        base = [word() for _ in range(rng.choice((20, 60, 200, 900)))]
        for _ in range(rng.choice((2, 2, 2, 5, 40))):
            text = list(base)
            for at in rng.sample(range(len(base)), rng.randrange(len(base) // 30 + 1)):
                text[at] = word()
            rows.append((len(rows), " ".join(text), "en", 1, "x", 2.5))
    want = plain_kept(rows)
    got = {r.doc_id for r in simhash.deduplicate(frame(spark, rows), distance=0, blocks=1).collect()}
    assert got == want


def test_intermediates_are_deleted(spark):
    import os

    from tessera.llm.common import scratch_root

    before = set(os.listdir(scratch_root(spark)))
    left = simhash.deduplicate(frame(spark, documents()))
    n = left.count()
    found = sorted(p.split("-")[1] for p in set(os.listdir(scratch_root(spark))) - before)
    assert found == ["dedup", "gone"] and left.count() == n


def test_longer_keys_of_wide_fingerprints(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join("x" if j == 9 * k else w for j, w in enumerate(base)) for k in range(12)]
    wide = [simhash.wide_fingerprint(t) for t in texts]
    df = spark.createDataFrame([(k, k, w) for k, w in enumerate(wide)], "node long, label long, wide array<long>")
    found = []
    for bound in (64, 0):
        monkeypatch.setattr(simhash, "_TEXTS_A_KEY", bound)
        found.append({(r.a, r.b) for r in simhash.wide_links(df, [0, 1], 8, 0.2).collect()})
    assert found[1] and all(sum((p ^ q) & (2**64 - 1) != 0 and ((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(wide[a], wide[b])) <= 102 for f in found for a, b in f)


def test_links_of_wide_fingerprints_are_those_of_bands(spark, monkeypatch):
    """Whatever the length of keys and runs, no link comes that the bands don't give at any size."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join("x" if j == 9 * k else w for j, w in enumerate(base)) for k in range(40)]
    texts = [(k, k, simhash.wide_fingerprint(t), simhash.band_keys(simhash._shingle_hashes(t, 5))) for k, t in enumerate(texts)]
    alone = [(k, n, w, bands if k % 2 else [k]) for k, n, w, bands in texts]  # as if every second text shared no band
    df = spark.createDataFrame(alone, "node long, label long, wide array<long>, bands array<long>")
    for texts_a_key, short in ((64, 16), (0, 16), (64, 64), (64, 2)):
        monkeypatch.setattr(simhash, "_TEXTS_A_KEY", texts_a_key)
        monkeypatch.setattr(simhash, "_SHORT_WIDE_RUN", short)
        found = {(r.a, r.b) for r in simhash.wide_links(df, [0, 1], 8, 0.2).collect()}
        assert all(set(alone[a][3]) & set(alone[b][3]) for a, b in found)


def test_groups_of_long_texts_stay_small():
    """A family of long texts: its groups are bounded by their shingles, and one is compared in little memory."""
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63, 20_000)
    sets = []
    for _ in range(60):
        own = base.copy()
        own[rng.choice(len(base), 900, replace=False)] = rng.integers(-(2**63), 2**63, 900)
        sets.append(np.sort(own))
    size = np.array([len(h) for h in sets] * 40)
    parts = list(simhash._parts(len(size), np.arange(len(size)), size))
    assert all(size[mine].sum() <= 2 * (simhash._GROUP_SHINGLES + size.max()) for _, mine in parts)
    met = np.zeros((len(size), len(size)), bool)
    for _, mine in parts:
        met[np.ix_(mine, mine)] = True
    assert met.all() and len({part for part, _ in parts}) == len(parts)
    assert len(simhash._group_links(np.arange(len(sets)), sets, 0.8)) == len(sets) - 1


def test_holders_are_counted_in_parts(monkeypatch):
    rng = np.random.default_rng(6)
    sets = [np.sort(rng.choice(200, int(rng.integers(20, 190)), replace=False)) for _ in range(40)]
    sets += [np.sort(np.concatenate([s[2:], [300 + k]])) for k, s in enumerate(sets)]
    label = np.arange(len(sets))
    want = simhash._group_links(label, sets, 0.8)
    monkeypatch.setattr(simhash, "_HOLDERS", 50)
    assert simhash._group_links(label, sets, 0.8) == want and len(want) >= 40

import random
import time
from itertools import combinations

from tessera.llm import license_scan as ls
from tessera.llm.license_texts import TEMPLATES
from tests.llm.samples import documents, frame, text


def plain_lis(places):
    for n in range(len(places), 0, -1):
        for c in combinations(range(len(places)), n):
            if all(places[a] < places[b] for a, b in zip(c, c[1:])):
                return n
    return 0


def test_increasing_is_longest():
    rng = random.Random(0)
    for _ in range(200):
        p = [rng.randrange(12) for _ in range(rng.randrange(9))]
        got = ls.increasing(p)
        assert got == sorted(got) and all(p[a] < p[b] for a, b in zip(got, got[1:])) and len(got) == plain_lis(p)


def test_alignment_is_in_order_and_equal():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(20))] for _ in range(2))
        pairs = ls.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    assert len(ls.align("the quick brown fox".split(), "the very quick fox".split())) == 3


PROBES = {
    "Released under the BSD License.": "BSD",
    "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
    "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the Foo License.": "",
    "Licensed under CC BY-XY 4.0.": "",
    "the MIT students released a song under water": "",
}


def names(text, templates=None):
    return ",".join(sorted({h.license for h in ls.scan(ls.words(text), 0.8, templates)}))


def test_a_notice_has_one_license():
    for line, want in PROBES.items():
        assert names(line) == names(f"some words before. {line} and some more after it") == want, line
    for name, texts in TEMPLATES.items():
        for t in texts:
            assert names(t) == name, t
    both = "Released under the MIT License.\n" + "word " * 30 + "Licensed under CC BY-SA 4.0."
    assert names(both) == "CC-BY-SA-4.0,MIT"


def all_windows(w, least=0.8):
    """Every window of every template, then the same competition."""
    hits = []
    for t in ls._default():
        slack = len(t.words) // 2 + 1
        for start in range(-len(t.words), len(w)):
            for margin in (0, slack):
                hit = ls._at(w, max(0, start - margin), max(0, start + len(t.words) + margin), t, least)
                if hit:
                    hits.append(hit)
    return ls.standing(hits)


def test_against_all_windows():
    rng = random.Random(6)
    every = [(name, t) for name, texts in sorted(TEMPLATES.items()) for t in texts]
    found = 0
    for _ in range(25):
        out = []
        for name, t in rng.sample(every, 2):
            w = t.split()
            for _ in range(rng.randrange(1 + len(w) // 8)):
                at = rng.randrange(len(w))
                w[at : at + rng.choice((0, 1))] = rng.choice((["so"], [], ["the", "said"]))
            out += text(rng, rng.randrange(20)).split() + w
        w = ls.words(" ".join(out))
        want, got = all_windows(w), ls.scan(w)
        assert [(h.license, h.coverage, h.aligned) for h in got] == [(h.license, h.coverage, h.aligned) for h in want]
        found += len(got)
    assert found > 25


def test_full_texts_from_a_folder(spark, tmp_path):
    (tmp_path / "House-1.txt").write_text("Guests of the house may read any book of it in the garden, and take one with them for the night if they leave a shoe. " * 3)
    df = frame(spark, [(1, (tmp_path / "House-1.txt").read_text(), "en", 1, "x", 2.5), (2, "Released under the MIT License.", "en", 1, "x", 2.5)])
    assert {r.doc_id: r.licenses for r in ls.scan_documents(df, folder=str(tmp_path)).collect()} == {1: "House-1", 2: "MIT"}


def test_time_on_texts_that_repeat_template_words():
    began = time.time()
    for t in ("license " * 40000, "the software is provided as is without warranty " * 4000, "Released under the MIT License.\n" * 8000, TEMPLATES["BSD-3-Clause"][2] * 60):
        assert len({h.license for h in ls.scan(ls.words(t))}) <= 1
    assert time.time() - began < 60


def test_notices_are_found_where_they_stand(spark):
    rng = random.Random(3)
    rows, want = documents(), {}
    for k, (name, texts) in enumerate(sorted(TEMPLATES.items())):
        for j, t in enumerate(texts):
            i = 10_000 + 10 * k + j
            rows.append((i, text(rng, 30) + "\n" + t + "\n" + text(rng, 30), "en", 1, "x", 2.5))
            want[i] = name
    changed = TEMPLATES["MIT"][2].replace("hereby", "herewith").replace("merge, ", "").upper()
    rows += [(900, changed, "en", 1, "x", 2.5), (901, "Released under the MIT License.\n" * 300, "en", 1, "x", 2.5), (902, "the MIT students released a song under water", "en", 1, "x", 2.5)]
    want |= {900: "MIT", 901: "MIT"}
    got = ls.scan_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.license == want.get(r.doc_id), r
        if r.license:
            assert r.coverage >= 0.8 and r.license in r.licenses.split(",") and 0 <= r.first_word < r.end_word <= r.n_words
    assert {r.coverage for r in got if r.doc_id in want and r.doc_id >= 10_000} == {1.0}
    assert ls.scan_documents(frame(spark, rows).where("false")).collect() == []

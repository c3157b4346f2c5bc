import hashlib
import random
import re

import pytest

from tessera.llm import decontaminate
from tests.llm.samples import WORDS, documents, frame, text

SEP = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return SEP.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, bench, span=8, least=2):
    windows = {}
    for item, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - span + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + span]), set()).add("" if item is None else str(item))
    out = []
    for doc, t, *_ in docs:
        w, hit, items = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    items |= found
        joined = ",".join(sorted(items))
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(joined.encode()).hexdigest(), len(items) >= least))
    return out


def fixture():
    rng = random.Random(11)
    bench = [(k, text(rng, rng.choice([2, 5, 8, 9, 14, 40]))) for k in range(25)] + [(9, "repeated item of nine words is here right now"), (9, "repeated item of nine words is here right now"), (30, None), (31, ""), (32, "--"), (None, "no id but words that go on for eight")]
    docs = documents()
    for k in range(30):
        item = bench[k % 25][1]
        w = item.split()
        part = " ".join(w[rng.randrange(3) :]).upper()
        docs.append((300 + k, text(rng, 20) + part + " " + text(rng, 9), "en", 1, "x", 2.5))
    docs.append((400, " ".join(["rain"] * 30), "en", 1, "x", 2.5))
    bench.append((40, " ".join(["rain"] * 12)))
    docs.append((401, "says: no id but words that go on for eight, and then some", "en", 1, "x", 2.5))
    return docs, bench


def test_against_brute_force(spark):
    docs, bench = fixture()
    table = spark.createDataFrame([(*b, "x") for b in bench], "item_id long, text string, h string")
    want = plain(docs, bench)
    key = lambda x: tuple((v is not None, v) for v in x)
    got = decontaminate.contamination(frame(spark, docs), table)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(w[3] for w in want) > 20


@pytest.mark.parametrize("key_bytes", [decontaminate.KEY_BYTES, -1])
def test_large_benchmarks(spark, monkeypatch, key_bytes):
    """The same by the index's hashes first, and by a shuffle of both sides."""
    docs, bench = fixture()
    table = spark.createDataFrame([(*b, "x") for b in bench], "item_id long, text string, h string")
    key = lambda x: tuple((v is not None, v) for v in x)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(decontaminate, "KEY_BYTES", key_bytes)
    got = decontaminate.contamination(frame(spark, docs), table)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(docs, bench), key=key)


@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_BYTES, -1])
def test_remove(spark, monkeypatch, bound):
    docs, bench = fixture()
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
    left = decontaminate.remove(frame(spark, docs), spark.createDataFrame(bench, "item_id long, text string"))
    key = lambda i: (i is not None, i)
    assert left.columns == ["doc_id", "text", "lang", "row", "fp", "part"]
    assert sorted((r.doc_id for r in left.collect()), key=key) == sorted((w[0] for w in plain(docs, bench) if not w[3]), key=key)


def test_long_items_only(spark):
    docs, bench = fixture()
    bench = [b for b in bench if len(words(b[1])) >= 8]
    table = spark.createDataFrame(bench, "item_id long, text string")
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, decontaminate.contamination(frame(spark, docs), table).collect()), key=key) == sorted(plain(docs, bench), key=key)


def test_empty_tables(spark):
    docs, bench = fixture()
    table = spark.createDataFrame(bench, "item_id long, text string")
    assert decontaminate.contamination(frame(spark, docs).where("false"), table).collect() == []
    none = decontaminate.contamination(frame(spark, docs), table.where("false")).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_hit for r in none)


def test_no_python_in_the_plan(spark):
    docs, bench = fixture()
    table = spark.createDataFrame(bench, "item_id long, text string")
    plan = decontaminate.contamination(frame(spark, docs), table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert WORDS

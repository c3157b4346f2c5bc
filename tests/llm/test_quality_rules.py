import re
from collections import Counter

from tessera.llm import quality_rules as q
from tests.llm.samples import documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def line_fails(line):
    w = WORD.findall(line)
    symbols, marks = len(re.findall(q.SYMBOLS, line)), len(re.findall("[!?]", line))
    lone = sum(x in ("|", ">", "»") for x in w)
    return (
        5 * symbols > sum(map(len, w))
        or (2 * marks >= len(w) and marks >= 3)
        or (lone >= 3 and 5 * lone > len(w))
        or 2 * sum(a == b for a, b in zip(w, w[1:])) > len(w)
        or (len(w) <= 30 and any(b in line.lower() for b in q.BOILERPLATE))
    )


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    chars = sum(map(len, w))
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    left = "\n".join(line for line in lines if not line_fails(line))
    lost = chars - sum(map(len, WORD.findall(left)))
    return len(w), chars, len(re.findall(q.SYMBOLS, text)), dup, len(again), failed, not failed and lost <= 0.3 * chars, left


def cases():
    prose = "Rain fell on the old stone bridge while the river rose slowly under its three low arches and nobody came by"
    extra = [
        prose + "\nhome | news | sport | contact | about\n" + prose.replace("Rain", "Snow").replace("river", "water"),
        "a### b*** c%%% d$$$ e&&& " * 10,
        "\n".join(["home | news | sport | contact | about | more"] * 2 + [f"x{i} | y{i} | z{i} | w{i}" for i in range(9)]),
        prose + "\nAll rights reserved.\n" + prose + "\n" + prose,
        " ".join(f"W{i}!!" for i in range(50)),
        prose + "\nReally? Yes! No! Oh my\nOh! No! Not a\nWhat? Oh! a b\n" + prose.lower(),
        prose + "\n" + prose + "\nend",
        "one line\none line\n\n\n \none line",
        " ".join(f"w{i}" for i in range(20)),
        " ".join(f"w{i // 6}" for i in range(48)),
        prose + "\nthe the the the\n" + prose.upper(),
        " ".join(f"w{i}" for i in range(19)),
    ]
    return documents() + [(500 + i, t, "en", 1, "x", 2.5) for i, t in enumerate(extra)]


def test_against_brute_force(spark):
    rows = cases()
    got = q.quality(frame(spark, rows)).drop("lost_chars").collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted([(r[0], *plain(r[1])) for r in rows], key=key)


def test_clean_keeps_columns_and_drops_lines(spark):
    rows = cases()
    got = q.clean(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "lang", "row", "fp", "part"]
    want = sorted((r[0], plain(r[1])[7]) for r in rows if plain(r[1])[6])
    assert sorted((r.doc_id, r.text) for r in got.collect()) == want and want
    assert q.clean(frame(spark, rows).where("false")).collect() == []
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()

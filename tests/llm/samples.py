"""Small documents for the operators' tests, with the awkward rows that each must survive."""

import random

WORDS = ["The", "and", "of", "Émile", "ñandú", "größe", "x1", "über", "a", "rain", "stone", "river", "don't", "e.g.", "12", "#tag", "|", "ÉCOLE", "日本", "lamp"]


def text(rng: random.Random, n: int, words=WORDS) -> str:
    out = []
    for _ in range(n):
        out.append(rng.choice(words))
        out.append(rng.choice([" ", " ", " ", " ", "\n", "  ", "\t"]))
    return "".join(out)


def documents(seed: int = 7, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, extra columns with the names that operators use themselves)."""
    rng = random.Random(seed)
    rows = [(i, text(rng, rng.choice([1, 3, 7, 8, 9, 30, 120]))) for i in range(n)]
    copy = rows[5][1]
    rows += [(100, copy), (101, copy), (101, copy), (102, None), (103, ""), (104, " \n\t "), (105, text(rng, 6000)), (None, "no id at all"), (None, None)]
    rows += [(106, "same words " * 40), (107, " odd spaces \x1f end\r\n"), (108, "<|endoftext|> is text"), (109, rows[6][1] + " tail")]
    return [(i, t, "en", 1, "x", 2.5) for i, t in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row int, fp string, part double").repartition(3)

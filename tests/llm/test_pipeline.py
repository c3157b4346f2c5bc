import random

import corpus_pipeline
from tessera.llm import quality_model as qm
from tests.llm.samples import text
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_quality_rules import plain as plain_rules
from tests.llm.test_simhash import plain_components, plain_print

PROSE = "rain stone bridge river lamp cloud field house winter summer letter garden window street market table paper wooden silver yellow seven morning evening".split()


def tables(spark, folder):
    rng = random.Random(4)
    docs = [(i, text(rng, 60, PROSE)) for i in range(40)]
    bench = [(k, text(rng, 25, PROSE)) for k in range(3)]
    docs += [(100 + k, docs[k][1]) for k in range(5)]  # copies
    docs += [(200 + k, text(rng, 40, PROSE) + " " + bench[k % 3][1]) for k in range(4)]
    docs += [(300 + k, " ".join(w + rng.choice(["###", "***"]) for w in text(rng, 50, PROSE).split())) for k in range(20)]
    docs += [(400, None), (401, ""), (None, text(rng, 50, PROSE)), (402, "short text"), (7, docs[7][1])]
    docs.append((500, text(rng, 80, PROSE) + "\nhome | news | sport | contact\n" + text(rng, 80, PROSE)))
    labels = [(i, int(i < 300), 0) for i, _ in docs if i is not None and i < 400]
    spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, bench


def test_stages_against_plain_python(spark, tmp_path):
    docs, bench = tables(spark, str(tmp_path))
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    key = lambda x: tuple((v is not None, v) for v in x)

    def rows(frame):
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=key)

    stages = [f for _, f in corpus_pipeline.STAGES]
    df = stages[0](spark, df, str(tmp_path))
    want = sorted(((i, plain_rules(t)[7]) for i, t in docs if plain_rules(t)[6]), key=key)
    assert rows(df) == want and 20 < len(want) < len(docs)

    df = stages[1](spark, df, str(tmp_path))
    model = qm.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    want = [(i, t) for i, t in want if model.scores(qm.features(t)[None])[0] >= 0.3]
    assert rows(df) == want

    df = stages[2](spark, df, str(tmp_path))
    labels = plain_components([plain_print(t) for _, t in want])
    first = {}
    for (i, t), c in zip(want, labels):
        if c not in first or (i is not None and (first[c][0] is None or i < first[c][0])):
            first[c] = (i, t)
    want = sorted(first.values(), key=key)
    assert rows(df) == want

    df = stages[3](spark, df, str(tmp_path))
    hit = {(r[0], r[1]): r[3] for r in ((i, t, *h[2:]) for (i, t), h in zip(want, plain_hits(want, bench)))}
    want = [(i, t) for i, t in want if not hit[i, t]]
    assert rows(df) == want and not any(200 <= (i or 0) < 300 for i, _ in want)

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in want}
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def test_empty_documents(spark, tmp_path):
    tables(spark, str(tmp_path / "full"))
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/full/{name}.parquet").where("false").write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []

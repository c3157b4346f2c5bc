"""Benchmark decontamination by winnowing, in DataFrame and SQL functions only.

A text's k-gram hashes are winnowed: from every window of w consecutive hashes the smallest (the
leftmost of equals) is kept. With k + w - 1 = span, a span of that many words holds exactly one such
window, so whatever ``span`` words a document shares with a benchmark item, both keep the same k-gram
at the same place in them. Documents' kept k-grams are joined with those of the items' spans, and a hit
is extended over the whole span and verified word by word: no hash decides alone.

Items shorter than a span are one window of their own; documents are probed for their whole length.
Nulls, empty texts: no words, no hits, one row all the same. Repeated rows keep a row each; repeated
items count once. An item without an id counts as one whose id is the empty text. Very long texts are probed
whole, one probe for each kept k-gram. Empty tables: no rows, or rows without hits. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: An index of benchmark spans up to this size (bytes in memory, estimated from its own rows) is broadcast. Beyond it
#: its hashes alone are, up to KEY_BYTES, so that only probes that hit one are shuffled; beyond that both sides are.
BROADCAST_BYTES, KEY_BYTES = 16 << 20, 64 << 20


def words_column(text: str = "text"):
    """Words of a text column: A-Z lowered, parted by SEPARATORS; null: none."""
    c = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lowered = F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _gram_hashes(k: int) -> str:
    """Hashes of the k-grams of column words, from the words' hashes in column wh."""
    parts = ", ".join(f"wh[i + {j}]" for j in range(k))
    return f"case when size(wh) >= {k} then transform(sequence(0, size(wh) - {k}), i -> xxhash64({parts})) else array() end"


def _leftmost_least(w: int) -> str:
    """The place of the leftmost least of kh[i] to kh[i + w - 1]: the first that no later one is less than."""
    whens = []
    for j in range(w - 1):
        rest = [f"kh[i + {m}]" for m in range(j + 1, w)]
        whens.append(f"when kh[i + {j}] <= {f'least({chr(44).join(rest)})' if len(rest) > 1 else rest[0]} then i + {j}")
    return f"case {' '.join(whens)} else i + {w - 1} end" if whens else "i"


def _winnowed(rows: DataFrame, k: int, w: int) -> DataFrame:
    """Adds wh, kh (k-gram hashes) and, for each window of w of them, pick: the kept k-gram's place."""
    rows = rows.withColumn("wh", F.expr("transform(words, x -> xxhash64(x))"))
    rows = rows.withColumn("kh", F.expr(_gram_hashes(k)))
    return rows.withColumn("pick", F.expr(f"case when size(kh) >= {w} then transform(sequence(0, size(kh) - {w}), i -> {_leftmost_least(w)}) else array() end"))


def span_index(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = 8, k: int = 4) -> DataFrame:
    """(m, h, j, span_words, items): each distinct span of the benchmark (m words; m < span: a whole
    short item), the hash it is found by, that hash's place in it, and the items that hold it."""
    w = span - k + 1
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_column(text_col).alias("words")).where("size(words) > 0")
    long = _winnowed(items.where(f"size(words) >= {span}"), k, w).select(
        "item", F.expr(f"explode(transform(pick, (p, s) -> struct({span} as m, kh[p] as h, p - s as j, slice(words, s + 1, {span}) as span_words)))").alias("x")
    )
    short = items.where(f"size(words) < {span}").select("item", F.expr("struct(size(words) as m, xxhash64(words) as h, 0 as j, words as span_words)").alias("x"))
    return long.unionByName(short).select("item", "x.*").groupBy("m", "h", "j", "span_words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, span: int = 8, k: int = 4, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """For each row of docs: the columns keep, n_words, spans (array<struct<s,l>>: first word and length of
    each verified occurrence) and items (ids, as strings, of the items with one, sorted as strings)."""
    w = span - k + 1
    index = written(span_index(benchmark, span=span, k=k), "spans")
    shape = index.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json("span_words")) + F.length(F.to_json("items")) + 200).alias("bytes"), F.collect_set(F.when(F.col("m") < span, F.col("m"))).alias("short")).first()
    keep = keep or []
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(c) for c in keep], F.lit(0).alias("none")).alias("kept"), words_column(text_col).alias("words"))
    rows = _winnowed(rows.withColumn("n_words", F.size("words")), k, w).withColumn("pick", F.array_distinct("pick"))
    # What verifies a hit: the words that any span around the kept k-gram can cover.
    around = f"""transform(pick, p -> struct({span} as m, p, kh[p] as h, greatest(p - {w - 1}, 0) as c0,
        slice(words, greatest(p - {w - 1}, 0) + 1, least(p + {span}, size(words)) - greatest(p - {w - 1}, 0)) as ctx))"""
    shorts = [
        f"""case when size(words) >= {m} then transform(sequence(0, size(words) - {m}), p -> struct({m} as m, p,
            xxhash64(slice(words, p + 1, {m})) as h, p as c0, slice(words, p + 1, {m}) as ctx)) else array() end"""
        for m in sorted(shape["short"])
    ]
    # One probe without a place stands for the document itself; its hash is spread so that it makes no hot key.
    itself = "array(struct(-1 as m, -1 as p, xxhash64(row) as h, 0 as c0, cast(array() as array<string>) as ctx))"
    probes = rows.select("row", "kept", "n_words", F.expr(f"explode(concat({', '.join([itself, around, *shorts])}))").alias("x"))
    probes = probes.select("row", F.when(F.col("x.p") < 0, F.col("kept")).alias("kept"), F.when(F.col("x.p") < 0, F.col("n_words")).alias("n_words"), "x.*")
    index = index.select(F.col("m").alias("im"), F.col("h").alias("ih"), "j", "span_words", "items")
    if (shape["bytes"] or 0) <= BROADCAST_BYTES:
        index = F.broadcast(index)
    elif 64 * shape["n"] <= KEY_BYTES:
        known = F.broadcast(index.select(F.col("im").alias("m"), F.col("ih").alias("h"), F.lit(True).alias("known")).distinct())
        probes = probes.join(known, ["m", "h"], "left").where("p < 0 or known").drop("known")
    same = F.expr("case when p >= j and p - j >= c0 then slice(ctx, p - j - c0 + 1, m) = span_words else false end")
    found = probes.join(index, (F.col("m") == F.col("im")) & (F.col("h") == F.col("ih")) & same, "left").where("p < 0 or span_words is not null")
    spans = F.when(F.col("span_words").isNotNull(), F.struct((F.col("p") - F.col("j")).alias("s"), F.col("m").alias("l")))
    return (
        found.groupBy("row")
        .agg(F.first("kept", ignorenulls=True).alias("kept"), F.max("n_words").alias("n_words"), F.sort_array(F.collect_set(spans)).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        .select(*[F.col("kept")[c].alias(c) for c in keep], F.col("n_words").cast("long").alias("n_words"), "spans", "items")
    )


#: Words inside any of the spans (sorted by start): what each adds beyond those before it.
COVERED = """aggregate(spans, named_struct('e', 0, 't', 0L),
    (a, x) -> named_struct('e', greatest(a.e, x.s + x.l), 't', a.t + greatest(0, x.s + x.l - greatest(a.e, x.s))), a -> a.t)"""


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 8, k: int = 4, min_items: int = 2) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of docs."""
    found = hits(docs, benchmark, span, k, ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        F.expr(COVERED).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") >= min_items).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", span: int = 8, k: int = 4, min_items: int = 1) -> DataFrame:
    """docs without the rows that hold spans of min_items benchmark items or more; the same columns.

    The verdict depends on the text alone, so it is carried by the text's digest, not by a row number. The digests
    of what goes are written and counted: up to BROADCAST_BYTES they are broadcast and no text is shuffled.
    """
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keyed = docs.select(digest.alias("digest"), F.col(text_col).alias("text"))
    bad = written(hits(keyed, benchmark, span, k, ["digest"]).where(F.size("items") >= min_items).select("digest").distinct(), "digests")
    mark = "__tessera_digest"
    gone = bad.withColumnRenamed("digest", mark)
    if 100 * bad.count() <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    return docs.withColumn(mark, digest).join(gone, mark, "left_anti").drop(mark)


def oracle_sql(span: int = 8, min_items: int = 2) -> str:
    """contamination() in DuckDB's SQL, by all windows in the place of fingerprints."""
    words = lambda c: f"regexp_extract_all(translate(coalesce({c}, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words("text")} AS w FROM benchmark),
    bw AS (SELECT DISTINCT item, least(len(w), {span}) AS m, array_to_string(w[i:i + least(len(w), {span}) - 1], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {span - 2}, 2))) AS i FROM b WHERE len(w) > 0)),
    d AS (SELECT row_number() OVER () AS k, doc_id, {words("text")} AS w FROM documents),
    dw AS (SELECT k, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM (SELECT k, m, w, unnest(range(1, greatest(len(w) - m + 2, 1))) AS i FROM d, (SELECT DISTINCT m FROM bw))),
    h AS (SELECT dw.k, dw.i, dw.m, bw.item FROM dw JOIN bw USING (m, g)),
    c AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT k, i, m FROM h)) GROUP BY k),
    n AS (SELECT k, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM h) GROUP BY k)
    SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(n.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n.n, 0) >= {min_items} AS contaminated
    FROM d LEFT JOIN c USING (k) LEFT JOIN n USING (k)"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: spans of 8 words, found by 4-grams in windows of 5."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 8, 4, 2)

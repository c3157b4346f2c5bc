"""Quality rules, line first, in DataFrame and SQL functions only.

Every line with a word is held against the line rules below; failing lines are removed, and a document
that loses more than ``max_lost`` of its word characters is rejected. Before that, a document fails
the base rules with fewer than ``min_words`` words or when over ``max_repeat`` percent of its words lie
in windows of eight words that occur twice or more in it.

Line rules:
  punctuation  more than a fifth of the line's word characters are symbols of [#*$%&|<>], or there is an
               exclamation or question mark for every second word, three at least
  navigation   three or more words are a lone | or > or » and those are over a fifth of the words
  stutter      more than half of the words repeat the word before them
  boilerplate  a line of at most 30 words with one of BOILERPLATE in it

Nulls and empty texts: no words, base_failed. Very long texts are read whole. Lines without words are neither
kept nor lost. Repeated rows keep a row each. An empty table gives no rows. Input columns besides those named are ignored by
quality() and kept by clean().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CLASS, id_and_text, table

#: Phrases of page furniture, in lower case.
BOILERPLATE = ("all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies", "accept cookies", "enable javascript", "subscribe to our", "sign up for our", "click here to", "skip to content", "share this article", "lorem ipsum")
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
_SQL_SPACE = SPACE_CLASS.replace("\\", "\\\\")  # inside SQL text

#: Verdict of one line l: true if it fails. Counts come from splits, so nothing leaves the JVM.
LINE_FAILS = rf"""
    transform(array(named_struct(
        'w', array_remove(split(l, '{_SQL_SPACE}'), ''),
        'symbols', size(split(l, '{SYMBOLS}', -1)) - 1,
        'shouts', size(split(l, '[!?]', -1)) - 1)), x ->
      5 * x.symbols > length(array_join(x.w, ''))
      or 2 * x.shouts >= size(x.w) and x.shouts > 2
      or (size(filter(x.w, y -> y in ('|', '>', '»'))) >= 3 and 5 * size(filter(x.w, y -> y in ('|', '>', '»'))) > size(x.w))
      or 2 * size(filter(x.w, (y, i) -> i > 0 and y = x.w[greatest(i - 1, 0)])) > size(x.w)
      or size(x.w) <= 30 and l rlike '(?i){"|".join(BOILERPLATE)}'
    )[0]"""


def _measured(rows: DataFrame) -> DataFrame:
    """Adds the base counts and __text (what the line rules leave)."""
    rows = rows.withColumn("__s", F.coalesce(F.col("__raw").cast("string"), F.lit("")))
    rows = rows.withColumn("__w", F.array_remove(F.split("__s", SPACE_CLASS), "")).withColumn("__lines", F.split("__s", "\n"))
    rows = rows.withColumn("__h", F.expr("transform(__w, x -> xxhash64(x))"))
    # Hashes of the windows of eight words; nothing is sorted where all differ.
    eight = ", ".join(f"__h[i + {j}]" for j in range(WINDOW))
    rows = rows.withColumn("__win", F.expr(f"case when size(__h) >= {WINDOW} then transform(sequence(0, size(__h) - {WINDOW}), i -> xxhash64({eight})) else array() end"))
    rows = rows.withColumn("__same", F.expr("size(__win) - size(array_distinct(__win))"))
    rows = rows.withColumn("__sorted", F.expr("case when __same > 0 then sort_array(transform(__win, (h, i) -> struct(h, i))) else array() end"))
    # Of the sorted (hash, place) pairs those with a neighbour of the same hash, by place again.
    rows = rows.withColumn(
        "__again",
        F.expr(
            """sort_array(transform(filter(transform(__sorted, (x, i) -> struct(x.i as p,
                (i > 0 and x.h = __sorted[greatest(i - 1, 0)].h) or (i < size(__sorted) - 1 and x.h = __sorted[least(i + 1, size(__sorted) - 1)].h) as twice)),
                y -> y.twice), y -> y.p))"""
        ),
    )
    covered = f"aggregate(__again, named_struct('e', 0, 't', 0L), (a, p) -> named_struct('e', p + {WINDOW}, 't', a.t + p + {WINDOW} - greatest(a.e, p)), a -> a.t)"
    rows = rows.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": (F.size(F.split("__s", SYMBOLS, -1)) - 1).cast("long"),
            "n_repeat_words": F.expr(covered),
            "__full": F.expr(r"filter(__lines, l -> l rlike '[^\\x20\\x09-\\x0D]')"),
            "__text": F.array_join(F.expr(f"filter(__lines, l -> not {LINE_FAILS})"), "\n"),
        }
    )
    return rows.withColumn("n_dup_lines", (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long"))


def _judged(rows: DataFrame, min_words: int, max_repeat: int, max_lost: float) -> DataFrame:
    rows = _measured(rows)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    left = F.length(F.array_join(F.array_remove(F.split("__text", SPACE_CLASS), ""), "")).cast("long")
    lost: Column = F.col("word_chars") - left
    # The row number keeps a later filter above these columns; pushed below, it would repeat all of them.
    rows = rows.withColumns({"base_failed": failed, "lost_chars": lost, "__number": F.monotonically_increasing_id()})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= max_lost * F.col("word_chars")))


def quality(docs: DataFrame, min_words: int = 20, max_repeat: int = 30, max_lost: float = 0.3) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_chars, clean_text)."""
    rows = _judged(id_and_text(docs).withColumnRenamed("text", "__raw"), min_words, max_repeat, max_lost)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", F.col("__text").alias("clean_text"))


def clean(docs: DataFrame, text_col: str = "text", min_words: int = 20, max_repeat: int = 30, max_lost: float = 0.3) -> DataFrame:
    """The accepted rows of docs, their texts without the lines that fail a rule; the same columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text_col).alias("__raw"))
    rows = _judged(whole, min_words, max_repeat, max_lost).where("kept and __number >= 0")
    return rows.select(*[(F.col("__text") if c == text_col else F.col("__row")[c]).alias(c) for c in docs.columns])


def oracle_sql(min_words: int = 20, max_repeat: int = 30, max_lost: float = 0.3) -> str:
    """quality()'s figures and verdicts in DuckDB's SQL."""
    word = r"[^\x20\x09-\x0D]+"
    words = lambda c: f"regexp_extract_all({c}, '{word}')"
    lone = "list_filter(w, lambda y: y IN ('|', '>', '»'))"
    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT k, doc_id, t, {words("t")} AS w, string_split(t, chr(10)) AS lines FROM d),
    win AS (SELECT k, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT k, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS i FROM w)),
    twice AS (SELECT k, i FROM win SEMI JOIN (SELECT k, g FROM win GROUP BY k, g HAVING count(*) > 1) x USING (k, g)),
    rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY k),
    l AS (SELECT k, l, {words("l")} AS w, len(regexp_extract_all(l, '{SYMBOLS}')) AS symbols, len(regexp_extract_all(l, '[!?]')) AS marks FROM (SELECT k, unnest(lines) AS l FROM w)),
    good AS (SELECT k, sum(length(array_to_string(w, '')))::BIGINT AS chars FROM l WHERE NOT (5 * symbols > length(array_to_string(w, ''))
      OR (2 * marks >= len(w) AND marks > 2) OR (len({lone}) >= 3 AND 5 * len({lone}) > len(w))
      OR 2 * len(list_filter(range(2, greatest(len(w) + 1, 2)), lambda i: w[i] = w[i - 1])) > len(w)
      OR (len(w) <= 30 AND regexp_matches(l, '(?i){"|".join(BOILERPLATE)}'))) GROUP BY k),
    f AS (SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars, len(regexp_extract_all(t, '{SYMBOLS}')) AS n_symbols,
      len(list_filter(lines, lambda x: regexp_matches(x, '{word}'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '{word}')))) AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, coalesce(good.chars, 0) AS chars FROM w LEFT JOIN rep USING (k) LEFT JOIN good USING (k))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {min_words} OR 100 * n_repeat_words > {max_repeat} * n_words AS base_failed,
      NOT (n_words < {min_words} OR 100 * n_repeat_words > {max_repeat} * n_words) AND word_chars - chars <= {max_lost}::DOUBLE * word_chars AS kept FROM f"""


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by the rules above."""
    return quality(table(spark, sf_dir, "documents")).drop("lost_chars", "clean_text")

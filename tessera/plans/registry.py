"""The registered queries: each applies an operator to whole tables and has, where SQL can say it, a counterpart
that DuckDB runs on the same tables. Inputs are shared (plans/inputs.py), computations are not."""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import codetext, examples, mathrules, testcases
from tessera.operators import generate as generation
from tessera.operators import judge as judging
from tessera.operators import records as recording
from tessera.operators import resume, stats, tasks
from tessera.operators.judge import text_kernel
from tessera.operators.schema import KEY, RECORD, conform
from tessera.plans import inputs, jobs
from tessera.sources import scan, sinks
from tessera.streaming import compact

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _ORACLES[f.__name__] = sql
        return f

    return add


def given(**views: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in views.items())


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.load(spark, sf_dir, inputs.RECORDS)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.load(spark, sf_dir, inputs.ROWS)


_R, _T = given(r=inputs.RECORDS), given(r=inputs.ROWS)

# --- scans


@query("SELECT c_custkey, c_name, row_number() OVER () - 1 AS source_row, 'customer' AS stem FROM customer")
def scan_file_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of the files whose name ends in "er", its rows numbered as they lie in it."""
    files = scan.slice_files(scan.list_files(spark, sf_dir, "*er.parquet"), 0, 1)
    return scan.scan(spark, files).select("c_custkey", "c_name", "source_row", F.regexp_extract("source_file", r"([^/]*)\.parquet", 1).alias("stem"))


_ALL_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("SELECT " + " + ".join(f"(SELECT count(*) FROM {t})" for t in _ALL_TABLES) + " AS row_count")
def input_row_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scan.list_files(spark, sf_dir, "*.parquet")
    return spark.createDataFrame([(scan.estimate_rows(spark, files),)], "row_count long")


@query(
    f"""{given(v=inputs.LINES)}, g AS (SELECT c_custkey FROM v WHERE CASE WHEN trim(value) = '' THEN false ELSE json_valid(value) END)
    SELECT count(*) AS rows, sum(c_custkey)::BIGINT AS keys, 0::BIGINT AS wrongly_numbered FROM g"""
)
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-lines files with blank and broken lines: valid rows, numbered from 0 in each file without gaps."""
    folder = _scratch(spark, "lines")
    inputs.load(spark, sf_dir, inputs.LINES).repartition(4, "c_custkey").select("value").write.text(folder)
    files = scan.list_files(spark, folder, "*.txt")
    rows = scan.scan_jsonl(spark, files)
    each = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"), F.countDistinct("source_row").alias("numbers"), F.max("source_row").alias("last"))
    wrong = F.count_if((F.col("numbers") != F.col("n")) | (F.col("last") != F.col("n") - 1))
    return each.agg(F.sum("n").alias("rows"), F.sum("keys").alias("keys"), wrong.alias("wrongly_numbered"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder for a query's files, shared by driver and executors."""
    return f"{sinks.scratch(spark)}/{name}-{uuid.uuid4().hex}"


# --- tasks

_PROMPT = "nullif(trim(question), '')"


@query(f"{_T} SELECT source_file, source_row, k AS rollout_index, {_PROMPT} AS prompt_text FROM r, range(3) t(k) WHERE {_PROMPT} IS NOT NULL")
def task_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.make_tasks(_rows(spark, sf_dir), "question", 3)[0].select(*KEY, "prompt_text")


@query(f"{_T} SELECT source_file, source_row, 0::BIGINT AS rollout_index, 'empty_or_unsupported_input:question' AS reason FROM r WHERE {_PROMPT} IS NULL")
def prompt_empty_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.make_tasks(_rows(spark, sf_dir), "question", 3)[1]


@query(f"{_T} SELECT source_row, concat('{tasks.PYTHON_REQUEST}', {_PROMPT}) AS prompt_text FROM r WHERE {_PROMPT} IS NOT NULL")
def prompt_python_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.make_tasks(_rows(spark, sf_dir), "question", 1, ("opencode_reasoning_split_0",))[0].select("source_row", "prompt_text")


_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(
    f"""SELECT conv_id, string_agg({_TRIM.format("text")}, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role = 'user' AND {_TRIM.format("text")} <> '') AS prompt
    FROM conversations GROUP BY conv_id"""
)
def prompt_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.conversations(spark, sf_dir)
    return df.select("conv_id", tasks.prompt(df, "messages").alias("prompt"))


_DONE = given(r=inputs.ROWS, d=inputs.DONE, f=inputs.FAILED)
_TASKS = f"(SELECT source_file, source_row, k AS rollout_index FROM r, range(4) t(k) WHERE {_PROMPT} IS NOT NULL)"


def _pending(spark: SparkSession, sf_dir: str, completed: bool, failed: bool) -> DataFrame:
    todo = tasks.make_tasks(_rows(spark, sf_dir), "question", 4)[0].select(*KEY)
    done, lost = (inputs.load(spark, sf_dir, s) if use else None for s, use in ((inputs.DONE, completed), (inputs.FAILED, failed)))
    return tasks.pending(todo, done, lost)


@query(f"{_DONE} SELECT * FROM {_TASKS} EXCEPT ALL SELECT * FROM d WHERE source_row IN (SELECT source_row FROM r WHERE {_PROMPT} IS NOT NULL) AND rollout_index < 4")
def resume_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(spark, sf_dir, True, False)


@query(f"{_DONE} SELECT t.* FROM {_TASKS} t WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.source_file = t.source_file AND f.source_row = t.source_row AND f.rollout_index = t.rollout_index)")
def failure_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(spark, sf_dir, False, True)


@query(f"{_DONE} SELECT * FROM {_TASKS} EXCEPT (SELECT * FROM d UNION SELECT * FROM f)")
def pending_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(spark, sf_dir, True, True)


@query(f"{_DONE} SELECT * FROM d WHERE source_file IN ('/data/part-1.parquet', '/data/part-3.parquet')")
def resume_semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.of_files(inputs.load(spark, sf_dir, inputs.DONE), ["/data/part-1.parquet", "/data/part-3.parquet"])


@query("SELECT concat('/d/', CAST(c_nationkey AS STRING)) AS source_file, c_custkey AS source_row, CASE c_custkey % 4 WHEN 2 THEN 0 ELSE c_custkey % 3 END AS rollout_index FROM customer WHERE c_custkey % 4 < 3")
def resume_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.parse_index(inputs.load(spark, sf_dir, inputs.INDEX_LINES))


@query(f"{_DONE} SELECT DISTINCT * FROM f WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.source_file = f.source_file AND d.source_row = f.source_row AND d.rollout_index = f.rollout_index)")
def new_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.new_failures(inputs.load(spark, sf_dir, inputs.FAILED), inputs.load(spark, sf_dir, inputs.DONE))


# --- records

_NAME = "coalesce(nullif(trim(dataset_name), ''), nullif(trim(dataset), ''), regexp_extract(source_file, '([^/]*)\\.[^.]*$', 1))"


@query(f"{_T} SELECT source_row, {_NAME} AS dataset_name FROM r")
def dataset_name_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _rows(spark, sf_dir)
    return df.select("source_row", recording.dataset_name(df).alias("dataset_name"))


@query(f"{_T} SELECT source_row, k AS rollout_index, {_NAME} || ':' || source_file || ':' || source_row || ':rollout_' || k AS sample_id FROM r, range(2) t(k)")
def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _rows(spark, sf_dir)
    return tasks.rollouts(df.withColumn("dataset_name", recording.dataset_name(df)), 2).select("source_row", "rollout_index", recording.sample_id().alias("sample_id"))


_TEMPLATE = json.dumps(dict.fromkeys(recording.METADATA_KEYS), sort_keys=True)


@query(f"{_T} SELECT source_row, coalesce(metadata, '{_TEMPLATE}') AS metadata FROM r")
def metadata_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _rows(spark, sf_dir)
    return df.select("source_row", recording.metadata(df).alias("metadata"))


_V = given(t=inputs.TURNS)
_SIZE = " + ".join(f"coalesce(length({c}), 0)" for c in ("content", "reasoning_content", "tool_calls", "tool_call_id", "name"))


@query(
    f"""{_V} SELECT conv_id, sum({_SIZE})::BIGINT AS content_chars, count(*) AS turn_count, bool_or(coalesce(trim(reasoning_content), '') <> '') AS has_reasoning,
    coalesce(arg_max(content, turn) FILTER (WHERE role = 'assistant'), '') AS last_answer FROM t GROUP BY conv_id"""
)
def message_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("messages")
    return inputs.conversations(spark, sf_dir).select(
        "conv_id", recording.content_chars(m).alias("content_chars"), F.size(m).cast("long").alias("turn_count"), recording.has_reasoning(m).alias("has_reasoning"), recording.last_answer(m).alias("last_answer")
    )


def _json(c: str) -> str:
    return f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')"


_CANON = " || ".join(
    ["'{\"content\": '", _json("content"), "', \"name\": '", _json("name"), "', \"reasoning_content\": '", _json("reasoning_content"), "', \"role\": '", _json("role"), "', \"tool_call_id\": '", _json("tool_call_id"), "', \"tool_calls\": '", "coalesce(tool_calls, 'null')", "'}'"]
)
_HASHES = f"SELECT conv_id, sha256('[' || string_agg({_CANON}, ', ' ORDER BY turn) || ']') AS dedup_hash FROM t GROUP BY conv_id"


@query(f"{_V} {_HASHES}")
def dedup_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.conversations(spark, sf_dir).select("conv_id", recording.dedup_hash(F.col("messages")).alias("dedup_hash"))


@query(f"{_V} SELECT count(DISTINCT dedup_hash) AS n FROM ({_HASHES})")
def dedup_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_hash(spark, sf_dir).agg(F.countDistinct("dedup_hash").alias("n"))


# --- texts and answers

_C = given(c=inputs.CODE)


def _signs(column: str, signs: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({column}, '')), '{s}')" for s in signs) + ")"


def _sum(column: str, signs: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"contains(lower({column}), '{s}')::INT" for s in signs) + ")"


@query(
    f"""{_C} SELECT p_partkey, {_sum("code", codetext.PYTHON_SIGNS)} - 3 * {_sum("code", codetext.FOREIGN_SIGNS)} + 2 * contains(lower(code), 'class solution')::INT
    + (length(code) - length(replace(code, chr(10), '')) >= 2)::INT - 5 * regexp_full_match(code, '[0-9\\s.-]+')::INT AS score FROM c"""
)
def python_block_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.load(spark, sf_dir, inputs.CODE).select("p_partkey", judging.python_score(F.col("code")).alias("score"))


@query(
    f"""{_C} SELECT p_partkey, coalesce(entry_point, '') <> '' OR {_signs("dataset", codetext.CODE_DATASETS)} OR {_signs("solution", codetext.CODE_SIGNS)}
    OR {_signs("question", codetext.CODE_PHRASES)} AS is_code FROM c"""
)
def looks_like_code_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.load(spark, sf_dir, inputs.CODE)
    return df.select("p_partkey", judging.is_code_task(df).alias("is_code"))


@query(f"{_C} SELECT p_partkey, coalesce(nullif(trim(answer), ''), CAST(label AS STRING)) AS answer FROM (SELECT p_partkey, answer, label FROM c)")
def math_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.load(spark, sf_dir, inputs.CODE).select("p_partkey", "answer", "label")
    return df.select("p_partkey", judging.reference_answer(df).alias("answer"))


_M = given(m=inputs.MATH)


#: What the last \\boxed holds: the text after it up to the brace that closes it.
_BOXED = """{0}, b1 AS (SELECT *, string_split(answer, chr(92) || 'boxed') AS parts FROM m),
    b2 AS (SELECT *, CASE WHEN len(parts) > 1 AND parts[-1][1] = '{{' THEN parts[-1][2:] END AS body FROM b1),
    b3 AS (SELECT *, [i FOR i IN range(1, coalesce(length(body), 0) + 1) IF body[i] = '}}' AND length(replace(body[1:i], '{{', '')) - length(replace(body[1:i], '}}', '')) = 1] AS ends FROM b2),
    b AS (SELECT *, CASE WHEN len(ends) > 0 THEN body[1:ends[1] - 1] END AS held FROM b3)""".format(_M)


@query(f"{_BOXED} SELECT o_orderkey, held FROM b")
def boxed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = text_kernel(mathrules.boxed, "string")
    return inputs.load(spark, sf_dir, inputs.MATH).select("o_orderkey", held("answer").alias("held"))


def _number(text: str) -> str:
    """The value of an answer: a fraction or a number, without units, wrappers and what it is set equal to."""
    bare = f"regexp_replace(regexp_replace({text}, '^[{{]?x=|[\\$ ]|dollars|\\\\text[{{].*?[}}]', '', 'g'), '^[{{]([0-9.]+)[}}]$', '\\1')"
    part = lambda k: f"nullif(regexp_extract({bare}, '^\\\\frac[{{]?([0-9])[}}]?[{{]?([0-9])[}}]?$|^([0-9]+)/([0-9]+)$', {k}), '')::DOUBLE"
    return f"coalesce({part(1)} / {part(2)}, {part(3)} / {part(4)}, TRY_CAST({bare} AS DOUBLE))"


#: Said and wanted numbers: of what is boxed, else of the first sentence that announces an answer.
_GRADED = f"""{_BOXED}, s AS (SELECT o_orderkey, answer, coalesce(held, regexp_extract(coalesce([x FOR x IN string_split(answer, '.') IF contains(x, 'answer is')][1], string_split(answer, '.')[1]), '(?:.*answer is)?(.*)$', 1)) AS said,
      coalesce(nullif(regexp_extract(solution, 'boxed[{{](.*)[}}]', 1), ''), solution) AS wanted FROM b),
    g AS (SELECT o_orderkey, answer, coalesce({_number("said")} = {_number("wanted")}, false) AS good FROM s)"""


@query(f"{_GRADED} SELECT o_orderkey, 'math' AS judge_type, 'math_rule' AS judge_backend, good AS is_correct, CASE WHEN good THEN 'pass' ELSE 'wrong_answer' END AS judge_status, 'math_verify_unavailable' AS fallback FROM g")
def math_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by rules. A decimal answer outside a box is cut at its point, so it can agree with a whole reference."""
    df = inputs.with_messages(inputs.load(spark, sf_dir, inputs.MATH))
    judged = judging.judge(df, ["solution"])
    return judged.select("o_orderkey", "judge_type", "judge_backend", "is_correct", "judge_status", F.get_json_object("judge_detail", "$.verify_fallback_reason").alias("fallback"))


#: Examples of a text: what follows its heading, up to a line that ends them, cut at the lines that name an input.
_E = f"""{given(t=inputs.EXAMPLES)}, h AS (SELECT *, string_split_regex(chr(10) || input, '\n(?:Examples?|Samples?):?\n') AS parts FROM t),
    x AS (SELECT *, CASE WHEN len(parts) > 1 THEN chr(10) || string_split_regex(parts[-1], '\n(?:Note|Constraints):?\n')[1] ELSE '' END AS body FROM h),
    e AS (SELECT source_file, source_row, len([p FOR p IN string_split_regex(body, '\n(?:Sample )?[Ii]nput:?')[2:] IF len(string_split_regex(p, '\n(?:Sample )?[Oo]utput:?')) > 1
      AND trim(string_split_regex(p, '\n(?:Sample )?[Oo]utput:?')[1], ' ' || chr(10)) <> '' AND trim(string_split_regex(p, '\n(?:Sample )?[Oo]utput:?')[2], ' ' || chr(10)) <> '']) AS n FROM x)"""


@query(f"{_E} SELECT source_file, source_row, n::BIGINT AS n_examples FROM e")
def example_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = text_kernel(lambda t: len(examples.parse(t)), "long")
    return inputs.load(spark, sf_dir, inputs.EXAMPLES).select("source_file", "source_row", count("input").alias("n_examples"))


@query(
    f"""{given(o=inputs.OUTPUTS)}, l AS (SELECT o_orderkey, [trim(x) FOR x IN string_split(output, chr(10)) IF trim(x) <> ''] AS g, [trim(x) FOR x IN string_split(expected, chr(10)) IF trim(x) <> ''] AS w FROM o),
    n AS (SELECT *, len(g) > 0 AND len(g) = len(w) AS lined, len([x FOR x IN g || w IF TRY_CAST(x AS DOUBLE) IS NULL]) = 0 AS numbers, len([x FOR x IN g || w IF NOT regexp_full_match(x, '-?[0-9]+')]) = 0 AS whole FROM l)
    SELECT o_orderkey, g = w OR (NOT (len(g) > 0 AND len(w) > 0 AND whole) AND (
      (lined AND numbers AND len([i FOR i IN range(1, len(g) + 1) IF abs(TRY_CAST(g[i] AS DOUBLE) - TRY_CAST(w[i] AS DOUBLE)) > greatest(1e-9, 1e-9 * greatest(abs(TRY_CAST(g[i] AS DOUBLE)), abs(TRY_CAST(w[i] AS DOUBLE))))]) = 0)
      OR (lined AND [list_sort(list_distinct(string_split(x, ' '))) FOR x IN g] = [list_sort(list_distinct(string_split(x, ' '))) FOR x IN w]))) AS same FROM n"""
)
def compare_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = text_kernel(testcases.same_output, "boolean")
    return inputs.load(spark, sf_dir, inputs.OUTPUTS).select("o_orderkey", same("output", "expected").alias("same"))


@query(
    f"""{given(f=inputs.FENCED)}, b AS (SELECT p_partkey, regexp_extract_all(answer, '(?s)```([A-Za-z]*)\n(.*?)```', 1) AS tags, regexp_extract_all(answer, '(?s)```([A-Za-z]*)\n(.*?)```', 2) AS codes, answer FROM f),
    t AS (SELECT *, [codes[i] FOR i IN range(1, len(codes) + 1) IF lower(tags[i]) IN ('python', 'py')] AS tagged, [c FOR c IN codes IF contains(c, 'def ') OR contains(c, 'print(')] AS like_python FROM b)
    SELECT p_partkey, coalesce(tagged[-1], like_python[1], codes[1], trim(answer, ' ' || chr(10))) AS code FROM t"""
)
def code_block_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The program in an answer: its last tagged block, else the one that looks like Python, else the first, else all."""
    code = text_kernel(codetext.program, "string")
    return inputs.load(spark, sf_dir, inputs.FENCED).select("p_partkey", code("answer").alias("code"))


_SUSPICIOUS = """(dataset_name = 'code_contests' AND judge_type = 'math') IS TRUE
    OR (judge_detail LIKE '%Input%' AND judge_detail LIKE '%Output%') IS TRUE OR (judge_detail LIKE '%"expected": "%Constraints%') IS TRUE
    OR (judge_status = 'wrong_answer' AND coalesce(json_extract_string(judge_detail, '$.output'), '') = '' AND source_row % 8 = 0) IS TRUE
    OR (judge_status = 'failed' AND source_row % 8 = 0) IS TRUE"""


@query(f"{_R} SELECT source_row, rollout_index, ({_SUSPICIOUS}) AS suspicious FROM r")
def suspicious_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.with_messages(_records(spark, sf_dir))
    return df.select("source_row", "rollout_index", F.coalesce(judging.is_suspicious(), F.lit(False)).alias("suspicious"))


# --- reports


@query(f"{_R} SELECT count(*) AS total, count(*) FILTER (is_correct) AS n_true, count(*) FILTER (NOT is_correct) AS n_false, count(*) FILTER (is_correct IS NULL) AS n_none, coalesce(100.0::DOUBLE * count(*) FILTER (is_correct) / nullif(count(is_correct), 0), 0) AS accuracy FROM r")
def stats_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.overall(_records(spark, sf_dir))


def _counts(column: str):
    @query(f"{_R} SELECT coalesce(nullif({column}, ''), 'none') AS {column}, count(*) AS n FROM r GROUP BY 1")
    def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stats.counts_by(_records(spark, sf_dir), column)

    name = f"stats_{column}"
    _QUERIES[name], _ORACLES[name] = _QUERIES.pop("counts"), _ORACLES.pop("counts")


for _column in stats.GROUPS.values():
    _counts(_column)


@query(f"{_R} SELECT coalesce(nullif(judge_backend, ''), 'none') AS judge_backend, count(*) FILTER (is_correct) AS n_correct, count(*) AS total, 100.0::DOUBLE * count(*) FILTER (is_correct) / count(*) AS accuracy FROM r GROUP BY 1")
def stats_backend_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.backend_accuracy(_records(spark, sf_dir))


@query(
    f"""{_R}, x AS (SELECT count(*) AS total, count(*) FILTER (generation_finish_reason = 'length') AS a, count(*) FILTER (generation_finish_reason = 'length' AND is_correct) AS b FROM r)
    SELECT a AS overlong_total, 100.0::DOUBLE * a / total AS overlong_ratio, b AS overlong_correct, 100.0::DOUBLE * b / a AS overlong_accuracy FROM x"""
)
def stats_overlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.overlong(_records(spark, sf_dir))


@query(
    f"""{_R}, x AS (SELECT count(*) FILTER (judge_backend = 'math_verify') AS v, count(*) FILTER (judge_backend = 'math_rule') AS m FROM r)
    SELECT v + m AS math_total, v AS math_verify_total, m AS math_rule_total, 100.0::DOUBLE * v / (v + m) AS math_verify_ratio, 100.0::DOUBLE * m / (v + m) AS math_rule_ratio FROM x"""
)
def stats_math_backends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.math_backends(_records(spark, sf_dir))


@query(f"{_R} SELECT json_extract_string(judge_detail, '$.verify_fallback_reason') AS reason, count(*) AS n FROM r GROUP BY 1 HAVING reason IS NOT NULL")
def stats_fallback_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.fallback_reasons(_records(spark, sf_dir))


_FACETS = {"judge_type": "coalesce(nullif(judge_type, ''), 'none')", "judge_backend": "coalesce(nullif(judge_backend, ''), 'none')", "judge_status": "coalesce(nullif(judge_status, ''), 'none')", "finish_reason": "coalesce(nullif(generation_finish_reason, ''), 'none')", "fallback_reason": "json_extract_string(judge_detail, '$.verify_fallback_reason')", "correct": "CASE WHEN is_correct THEN 'true' WHEN NOT is_correct THEN 'false' ELSE 'none' END", "total": "'all'"}


@query(_R + " " + " UNION ALL ".join(f"SELECT '{f}' AS facet, {s} AS value, count(*) AS n, count(*) FILTER (is_correct) AS n_correct, count(*) FILTER (NOT is_correct) AS n_false FROM r WHERE {s} IS NOT NULL GROUP BY 1, 2" for f, s in _FACETS.items()))
def stats_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.breakdown(_records(spark, sf_dir))


def _token_sql(source: str, condition: str = "true", averages: bool = True) -> str:
    parts = [f"count({f}) FILTER ({condition}) AS {f}_count, coalesce(sum({f}) FILTER ({condition}), 0)::BIGINT AS {f}_sum" + (f", avg({f}) FILTER ({condition}) AS {f}_avg" if averages else "") for f in stats.TOKEN_FIELDS]
    return f"SELECT count(*) AS record_count, count(*) FILTER ({condition}) AS counted_records, {', '.join(parts)} FROM {source}"


@query(f"{_R} {_token_sql('r')}")
def token_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_averages(stats.token_sums(_records(spark, sf_dir)))


@query(f"{_R} {_token_sql('r', 'is_correct')}")
def token_averages_correct_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_averages(stats.token_sums(_records(spark, sf_dir), only_correct=True))


@query(f"{_R} {_token_sql('r')}")
def incremental_token_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums of each source file's records, worked out apart in one pass, merged."""
    parts = stats.token_sums(_records(spark, sf_dir), by=("source_file",))
    return stats.with_averages(stats.merge_token_sums(parts.drop("source_file")))


@query(f"{_R} SELECT source_file, source_row, rollout_index FROM r WHERE is_correct")
def correct_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_records(spark, sf_dir), RECORD).where(stats.correct()).select(*KEY)


@query(f"{_R} SELECT count(DISTINCT (source_file, source_row, rollout_index)) AS written, count(DISTINCT (source_file, source_row, rollout_index)) FILTER (is_correct) AS correct, count(DISTINCT (source_file, source_row, rollout_index)) FILTER (generation_finish_reason = 'length') AS overlong FROM r")
def resume_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.struct(*KEY)
    return _records(spark, sf_dir).agg(
        F.countDistinct(key).alias("written"), F.countDistinct(F.when(stats.correct(), key)).alias("correct"), F.countDistinct(F.when(F.col("generation_finish_reason") == "length", key)).alias("overlong")
    )


@query(
    f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (ORDER BY name) AS k FROM ({inputs.SEGMENTS})),
    f AS (SELECT k, name, bytes, bytes AS held, 0 AS shard FROM s WHERE k = 1 UNION ALL
      SELECT s.k, s.name, s.bytes, CASE WHEN f.held + s.bytes > 10000 THEN s.bytes ELSE f.held + s.bytes END, CASE WHEN f.held + s.bytes > 10000 THEN f.shard + 1 ELSE f.shard END FROM f JOIN s ON s.k = f.k + 1)
    SELECT name, bytes, shard FROM f"""
)
def segment_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact.pack_segments(inputs.load(spark, sf_dir, inputs.SEGMENTS), 10000)


@query(f"{given(s=inputs.SEGMENTS)} SELECT max(CAST(regexp_extract(name, 'segment_([0-9]+)', 1) AS BIGINT)) + 1 AS next_index FROM s")
def next_segment_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(resume.next_index(inputs.load(spark, sf_dir, inputs.SEGMENTS)),)], "next_index long")


# --- jobs


@query(f"""{given(r=inputs.RECORDS, s=inputs.ROWS)} SELECT r.source_file, r.source_row, r.rollout_index, s.question FROM r LEFT JOIN s USING (source_file, source_row)""")
def source_row_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jobs.source_rows(_records(spark, sf_dir), _rows(spark, sf_dir), ["question"])
    return found.select(*KEY, F.col("source.question").alias("question"))


def _rejudged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.with_messages(_records(spark, sf_dir))
    return jobs.rejudge(df, _rows(spark, sf_dir).select("source_file", "source_row", F.col("question").alias("answer")), suspicious_only=True)


_JUDGED_AGAIN = f"{given(r=inputs.RECORDS, s=inputs.ROWS)}, a AS (SELECT *, ({_SUSPICIOUS}) AS again FROM r), j AS (SELECT a.*, {_PROMPT} IS NOT NULL AS has FROM a LEFT JOIN s USING (source_file, source_row))"


@query(
    f"""{_JUDGED_AGAIN} SELECT CASE WHEN has THEN 'wrong_answer' ELSE 'not_applicable' END AS judge_status, CASE WHEN has THEN false END AS is_correct, count(*) AS n FROM j
    WHERE again AND NOT (judge_type IS NOT DISTINCT FROM CASE WHEN has THEN 'math' END AND judge_backend IS NOT DISTINCT FROM CASE WHEN has THEN 'math_rule' END
      AND judge_status IS NOT DISTINCT FROM CASE WHEN has THEN 'wrong_answer' ELSE 'not_applicable' END AND is_correct IS NOT DISTINCT FROM CASE WHEN has THEN false END) GROUP BY ALL"""
)
def rejudge_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What suspicious records are judged to be when their answers meet an order's text instead of a test."""
    return jobs.change_counts(_rejudged(spark, sf_dir))


_FOUND = f"""{given(r=inputs.HYDRATE, l=inputs.LOOKUP)}, k AS (SELECT *, CASE WHEN lower(dataset) IN ('apps', 'taco') AND regexp_full_match(trim(index), '[0-9]+') THEN lower(dataset) END AS d, coalesce(split, 'train') AS sp FROM r),
    h AS (SELECT k.id, k.input, k.input_output, k.d, l.question, coalesce(l.tests, '') AS tests FROM k LEFT JOIN l ON l.dataset = k.d AND l.split = k.sp AND l.index = TRY_CAST(trim(k.index) AS BIGINT)),
    o AS (SELECT id, coalesce(nullif(trim(question), ''), input) AS input, CASE WHEN d IS NULL THEN coalesce(input_output, '') ELSE tests END AS input_output,
      CASE WHEN d IS NULL THEN '' ELSE d || '_source_dataset' END AS generated_test_source, 'source_dataset_v1' AS generated_test_parser,
      (CASE WHEN d IS NOT NULL AND tests <> '' THEN 1 ELSE 0 END)::BIGINT AS generated_test_count, CASE WHEN d IS NOT NULL AND tests <> '' THEN 'hydrated' ELSE 'missing' END AS generated_test_status FROM h)"""


def _hydrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.hydrate(inputs.load(spark, sf_dir, inputs.HYDRATE), inputs.load(spark, sf_dir, inputs.LOOKUP))


@query(f"{_FOUND} SELECT * FROM o")
def hydrate_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hydrated(spark, sf_dir).drop("dataset", "split", "index")


@query(f"{_FOUND} SELECT count(*) AS rows, count(*) FILTER (generated_test_status = 'hydrated') AS hydrated, count(*) FILTER (generated_test_status = 'hydrated')::DOUBLE / count(*) AS hydrate_rate FROM o")
def hydrate_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.hydrate_rate(_hydrated(spark, sf_dir))


@query(
    f"""{_E} SELECT source_file, count(*) AS rows, count(*) FILTER (n > 0) AS parsed_rows, coalesce(sum(n), 0)::BIGINT AS total_examples,
    count(*) FILTER (n > 0)::DOUBLE / count(*) AS parse_rate, coalesce(sum(n)::DOUBLE / nullif(count(*) FILTER (n > 0), 0), 0) AS avg_examples_per_parsed_row
    FROM e GROUP BY ROLLUP (source_file)"""
)
def prepare_test_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.prepare_rollup(jobs.prepare(inputs.load(spark, sf_dir, inputs.EXAMPLES)))


@query(
    f"""{_E} SELECT source_file, source_row, CASE WHEN n > 0 THEN 'prompt_examples' ELSE '' END AS generated_test_source, 'prompt_examples_v1' AS generated_test_parser,
    n::BIGINT AS generated_test_count, CASE WHEN n > 0 THEN 'parsed' ELSE 'missing' END AS generated_test_status FROM e"""
)
def prepare_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.prepare(inputs.load(spark, sf_dir, inputs.EXAMPLES)).drop("input", "input_output")


@query(f"{_GRADED} SELECT CASE WHEN good THEN 'pass' ELSE 'wrong_answer' END AS judge_status, contains(answer, '```') AS has_code_fence, count(*) AS n FROM g GROUP BY ALL")
def evaluate_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.load(spark, sf_dir, inputs.MATH).select(F.lit("orders").alias("source_file"), F.col("o_orderkey").alias("source_row"), F.col("answer").alias("output"), "solution")
    return jobs.evaluate(rows).groupBy("judge_status", "has_code_fence").agg(F.count(F.lit(1)).alias("n"))


# --- load figures

_Q = given(q=inputs.REQUESTS)


@query(
    f"""{_Q}, l AS (SELECT latency FROM q ORDER BY finished DESC, request_id DESC LIMIT 5000), v AS (SELECT list(latency ORDER BY latency) AS v, count(*) AS n, avg(latency) AS a FROM l)
    SELECT n, a AS avg_latency, {", ".join(f"v[round_even({p} / 100.0 * (n - 1), 0)::INT + 1] AS p{p}_latency" for p in (50, 95, 99))} FROM v"""
)
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.latency_percentiles(inputs.load(spark, sf_dir, inputs.REQUESTS))


@query(f"{_Q} SELECT request_id, count(latency) OVER w AS window_count, avg(latency) OVER w AS window_avg FROM q WINDOW w AS (PARTITION BY port ORDER BY finished, request_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)")
def sliding_latency_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sliding_latency(inputs.load(spark, sf_dir, inputs.REQUESTS), "port", 100).select("request_id", "window_count", "window_avg")


@query(f"{_Q} SELECT port, count(*) FILTER (ok) AS success, count(*) FILTER (NOT ok) AS failed FROM q GROUP BY port")
def port_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.port_counts(inputs.load(spark, sf_dir, inputs.REQUESTS))


@query(f"{_Q} SELECT request_id, CASE request_id % 3 WHEN 0 THEN 7001 WHEN 1 THEN 7005 ELSE 7002 END AS port FROM q")
def round_robin_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.load(spark, sf_dir, inputs.REQUESTS).select("request_id", stats.assigned_port(F.col("request_id"), [7001, 7005, 7002]).alias("port"))


# --- whole stages


def _said(answer: Column) -> Column:
    return F.array(F.struct(F.lit("assistant").alias("role"), answer.alias("content")))


#: A program is right if its number times its factor and its term make what is expected.
_RUN = f"""{given(p=inputs.PROGRAMS)}, g AS (SELECT *, CAST(given * factor + term AS VARCHAR) = expected AS good FROM p)"""


@query(
    f"""{_RUN} SELECT s_suppkey, CASE form WHEN 'assert' THEN 'code_mbpp' WHEN 'completion' THEN 'code_humaneval' WHEN 'examples' THEN 'code_prompt_examples' WHEN 'none' THEN 'code_unverified' ELSE 'code_livecodebench_generation' END AS judge_type,
    CASE WHEN form = 'none' OR form = 'examples' AND NOT good THEN 'not_applicable' WHEN good THEN 'pass' WHEN form = 'completion' THEN 'wrong_answer' ELSE 'wrong_answer' END AS judge_status,
    CASE WHEN form = 'none' OR form = 'examples' AND NOT good THEN NULL ELSE good END AS is_correct FROM g"""
)
def code_exec_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs run in the sandbox, one for each supplier: by assertions, as completions, by samples, by packed private
    tests, by the examples in a text (which no longer count if the reference solution fails them), or not at all."""
    df = inputs.load(spark, sf_dir, inputs.PROGRAMS)
    text = lambda c: F.col(c).cast("string")
    form = lambda k, column: F.when(F.col("form") == k, column)
    law = F.concat(F.lit(" * "), text("factor"), F.lit(" + "), text("term"))
    prints = F.concat(F.lit("print(int(input())"), law, F.lit(")"))
    function = F.concat(F.lit("def f(x):\n    return x"), law)
    wanted = F.concat(F.lit("assert f("), text("given"), F.lit(") == "), F.col("expected"))
    case = F.to_json(F.struct(F.array(text("given")).alias("inputs"), F.array("expected").alias("outputs")))
    packed = text_kernel(_packed_cases, "string")(F.to_json(F.array(F.struct(text("given").alias("input"), F.col("expected").alias("output")))))
    rows = df.select(
        "s_suppkey",
        form("assert", F.array(wanted)).alias("test_list"),
        form("completion", F.lit("import math\n\n")).alias("prompt"),
        form("completion", F.concat(F.lit("def check(g):\n    "), F.regexp_replace(wanted, "f\\(", "g("))).alias("test"),
        form("completion", F.lit("f")).alias("entry_point"),
        form("samples", case).alias("input_output"),
        form("private", packed).alias("private_test_cases"),
        form("examples", F.concat(F.lit("Compute.\nExample\nInput\n"), text("given"), F.lit("\nOutput\n"), F.col("expected"))).alias("input"),
        form("examples", prints).alias("solution"),
        form("none", F.lit("codeforces")).alias("dataset"),
        F.when(F.col("form").isin("assert", "completion"), F.concat(F.lit("```python\n"), function, F.lit("\n```")))
        .otherwise(F.concat(F.lit("```python\n"), prints, F.lit("\n```")))
        .alias("said"),
    ).withColumn("messages", _said(F.col("said")))
    columns = ["test_list", "prompt", "test", "entry_point", "input_output", "private_test_cases", "input", "solution", "dataset"]
    return judging.judge(rows, columns, seconds=60.0).select("s_suppkey", "judge_type", "judge_status", "is_correct")


def _packed_cases(cases: str | None) -> str | None:
    """Tests as private ones are stored: compressed and in base64."""
    return None if cases is None else base64.b64encode(zlib.compress(cases.encode())).decode()


@query(f"{_R} SELECT source_file, source_row, rollout_index, total_tokens FROM r WHERE is_correct")
def stored_and_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written in two batches, the first one compacted into shards before the second comes and both after it,
    and read back from the stream of correct ones."""
    folder, df = _scratch(spark, "records"), _records(spark, sf_dir)
    for part in (0, 1):
        sinks.append_records(df.where(F.col("source_row") % 2 == part), folder, 1 << 20)
        compact.compact(spark, folder, "correct", 4 << 20)
    return sinks.read_records(spark, folder, "correct").select(*KEY, "total_tokens")


@query(f"{_R} SELECT count(*) AS scanned_records, count(*) FILTER (is_correct) AS written_records, count(*) FILTER (generation_finish_reason = 'length') AS overlong_records, count(DISTINCT (source_file, source_row, rollout_index)) AS index_keys FROM r")
def rebuilt_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of a stream of correct records and an index that are made anew from the stream of all."""
    folder = _scratch(spark, "rebuilt")
    sinks.append_records(_records(spark, sf_dir), folder, 1 << 20)
    sinks.delete(spark, sinks.stream_path(folder, "correct", "segments"))
    sinks.delete(spark, sinks.index_path(folder))
    made = jobs.rebuild_correct(spark, folder)
    return spark.createDataFrame([tuple(made.values())], ", ".join(f"{k} long" for k in made))


@query(f"{_T} SELECT source_file, source_row, k AS rollout_index, 'Answer ' || left(sha256({_PROMPT}), 8) || '.' AS answer, 'stop' AS finish_reason, len(regexp_split_to_array({_PROMPT}, '\\s+')) + 2 AS total_tokens FROM r, range(2) t(k) WHERE {_PROMPT} IS NOT NULL")
def generate_mock(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = tasks.make_tasks(_rows(spark, sf_dir), "question", 2)[0].select(*KEY, "prompt_text")
    made = generation.generate(todo, generation.MockClient, ["http://127.0.0.1:1/v1"], 64)
    return made.select(*KEY, F.element_at("messages", 2)["content"].alias("answer"), "finish_reason", F.get_json_object("usage", "$.total_tokens").cast("long").alias("total_tokens"))


@query(
    f"""{_T} SELECT {_NAME} || ':' || source_file || ':' || source_row || ':rollout_' || k AS sample_id, 2::BIGINT AS turn_count, length({_PROMPT}) + 16 AS content_chars, 'math' AS judge_type, 'math_rule' AS judge_backend, false AS is_correct,
    len(regexp_split_to_array({_PROMPT}, '\\s+')) AS prompt_tokens FROM r, range(2) t(k) WHERE {_PROMPT} IS NOT NULL"""
)
def records_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks, mock answers, verdicts and records of all rows. (A real client's answers are written before they are judged.)"""
    rows = _rows(spark, sf_dir).withColumn("solution", F.col("source_file"))
    todo = tasks.make_tasks(rows, "question", 2)[0]
    made = generation.generate(todo, generation.MockClient, ["http://127.0.0.1:1/v1"], 64)
    built = recording.build(judging.judge(made, ["solution"]))
    return built.select("sample_id", "turn_count", "content_chars", "judge_type", "judge_backend", "is_correct", "prompt_tokens")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)

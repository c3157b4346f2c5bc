"""Inputs of the registered queries, derived from the driver's tables.

Each text is SQL that Spark and DuckDB both run, so a query's operator and its SQL counterpart see the
same rows; what the operator computes is never written down here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations", "labels")

#: Records of three datasets, all verdicts, backends and reasons mixed by moduli of the keys.
RECORDS = """
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'code_contests' ELSE concat('ds', CAST(o_orderkey % 3 AS STRING)) END AS dataset_name,
  concat('/data/part-', CAST(o_custkey % 5 AS STRING), '.parquet') AS source_file,
  o_orderkey AS source_row, o_orderkey % 4 AS rollout_index,
  CASE o_orderkey % 5 WHEN 0 THEN 'math' WHEN 1 THEN 'math' WHEN 2 THEN 'code_mbpp' WHEN 3 THEN '' END AS judge_type,
  CASE o_orderkey % 7 WHEN 0 THEN 'math_rule' WHEN 1 THEN 'math_verify' WHEN 2 THEN '' WHEN 3 THEN 'livecodebench_v6' WHEN 4 THEN 'math_rule' END AS judge_backend,
  CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE o_custkey % 3 = 1 END AS is_correct,
  CASE o_custkey % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'wrong_answer' WHEN 2 THEN 'failed' END AS judge_status,
  CASE WHEN o_custkey % 11 = 0 THEN 'length' WHEN o_custkey % 13 = 0 THEN NULL ELSE 'stop' END AS generation_finish_reason,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 1000 END AS prompt_tokens,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_custkey % 777 END AS completion_tokens,
  o_orderkey % 1000 + o_custkey % 777 AS total_tokens,
  CASE o_orderkey % 6 WHEN 0 THEN '{"verify_fallback_reason": "math_verify_unavailable"}' WHEN 1 THEN '{"expected": "Input 1 Output 2", "output": ""}'
    WHEN 2 THEN '{"expected": "3", "output": ""}' WHEN 3 THEN '{"verify_fallback_reason": "gold_parse_failed"}' WHEN 4 THEN '{"expected": "Constraints n", "output": "4"}' END AS judge_detail,
  CASE o_orderkey % 8 WHEN 0 THEN 'a ```python x``` b ```Python y``` c' WHEN 1 THEN '```python x```' WHEN 2 THEN NULL ELSE 'text' END AS answer
FROM orders"""

#: Rows with prompts, blanks and nulls.
ROWS = """
SELECT concat('/data/part-', CAST(o_custkey % 5 AS STRING), '.parquet') AS source_file, o_orderkey AS source_row,
  CASE o_orderkey % 10 WHEN 0 THEN '   ' WHEN 1 THEN NULL ELSE concat('  Order ', CAST(o_orderkey AS STRING), ' by ', o_orderpriority, ' ') END AS question,
  CASE o_orderkey % 4 WHEN 0 THEN ' named ' WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE 'other' END AS dataset_name,
  CASE o_custkey % 3 WHEN 0 THEN 'second' WHEN 1 THEN NULL ELSE '' END AS dataset,
  CASE WHEN o_orderkey % 3 = 0 THEN concat('{"k": ', CAST(o_custkey AS STRING), '}') END AS metadata
FROM orders"""

#: Keys done and keys failed, both with files and rows that the tasks lack.
DONE = """SELECT concat('/data/part-', CAST(o_custkey % 5 AS STRING), '.parquet') AS source_file, o_orderkey AS source_row, o_orderkey % 5 AS rollout_index FROM orders WHERE o_custkey % 2 = 0"""
FAILED = """SELECT concat('/data/part-', CAST(o_custkey % 6 AS STRING), '.parquet') AS source_file, o_orderkey AS source_row, 0 * o_orderkey AS rollout_index FROM orders WHERE o_custkey % 3 = 0"""

#: Lines of a completed index, old and new, with blank ones between.
INDEX_LINES = """
SELECT CASE c_custkey % 4 WHEN 0 THEN concat('/d/', CAST(c_nationkey AS STRING), chr(9), CAST(c_custkey AS STRING), chr(9), CAST(c_custkey % 3 AS STRING))
  WHEN 1 THEN concat('{"source_file": "/d/', CAST(c_nationkey AS STRING), '", "source_row": ', CAST(c_custkey AS STRING), ', "rollout_index": ', CAST(c_custkey % 3 AS STRING), '}')
  WHEN 2 THEN concat('{"source_file": "/d/', CAST(c_nationkey AS STRING), '", "source_row": ', CAST(c_custkey AS STRING), '}') ELSE '  ' END AS value
FROM customer"""

#: Answers in several spellings and a reference each, a third of them another number. (A tilde stands for a backslash,
#: which the two dialects quote apart.)
MATH = """
SELECT o_orderkey,
  replace(CASE o_orderkey % 11
    WHEN 0 THEN concat('So we get ~boxed{', CAST(o_custkey AS STRING), '} in all.')
    WHEN 1 THEN concat('First ~boxed{0}. The final answer is ~boxed{', CAST(o_custkey AS STRING), '}.')
    WHEN 2 THEN concat('Half: ~boxed{~frac', CAST(o_custkey % 9 + 1 AS STRING), CAST(o_orderkey % 7 + 1 AS STRING), '}')
    WHEN 3 THEN concat('Well. The answer is $', CAST(o_custkey AS STRING), '$ dollars. Bye.')
    WHEN 4 THEN concat('~boxed{x=', CAST(o_custkey AS STRING), '.00}')
    WHEN 5 THEN concat('The answer is ', CAST(o_custkey AS STRING), '.5')
    WHEN 6 THEN concat('~boxed{', CAST(o_custkey AS STRING), '~text{ cm}}')
    WHEN 7 THEN concat('~boxed{~frac{', CAST(o_custkey % 9 + 1 AS STRING), '}{', CAST(o_orderkey % 7 + 1 AS STRING), '}} of {all}')
    WHEN 8 THEN concat('~boxed{{', CAST(o_custkey AS STRING), '}}, said ', o_orderpriority)
    WHEN 9 THEN concat('open ~boxed{', CAST(o_custkey AS STRING))
    ELSE concat('no answer to ', o_orderpriority) END, '~', chr(92)) AS answer,
  CASE WHEN o_orderkey % 11 IN (2, 7) THEN concat(CAST((o_custkey + CASE WHEN o_custkey % 3 = 2 THEN 1 ELSE 0 END) % 9 + 1 AS STRING), '/', CAST(o_orderkey % 7 + 1 AS STRING))
    ELSE replace(concat('~boxed{', CAST(o_custkey + CASE WHEN o_custkey % 3 = 2 THEN 1 ELSE 0 END AS STRING), '}'), '~', chr(92)) END AS solution
FROM orders"""

#: Blocks of code and of other text.
CODE = """
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'def f(x):  return x' WHEN 1 THEN concat('print(', CAST(p_size AS STRING), ')', chr(10), 'a', chr(10), 'b')
  WHEN 2 THEN '#include <x> int main(' WHEN 3 THEN '1 2 3' WHEN 4 THEN concat('class Solution: ', p_name) ELSE p_name END AS code,
  CASE p_partkey % 5 WHEN 0 THEN 'LeetCode easy' WHEN 1 THEN 'algebra' END AS dataset,
  CASE p_partkey % 7 WHEN 0 THEN 'Write a program that adds' WHEN 1 THEN 'What is 2+2?' WHEN 2 THEN '' END AS question,
  CASE p_partkey % 11 WHEN 0 THEN 'x = input()' ELSE 'four' END AS solution,
  CASE p_partkey % 13 WHEN 0 THEN 'check' ELSE '' END AS entry_point,
  CASE p_partkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN concat(' ', p_brand) END AS answer, p_size AS label
FROM part"""

#: Task texts with up to three examples, some of them without an output, some after what ends the examples.
EXAMPLES = """
SELECT p_partkey AS source_row, concat('/in/', CAST(p_size % 4 AS STRING)) AS source_file, CASE WHEN p_partkey % 5 = 4 THEN concat('No input for ', p_name) ELSE concat(
  'Add ', p_brand, chr(10), CASE p_partkey % 3 WHEN 0 THEN 'Example' WHEN 1 THEN 'Examples:' ELSE 'Samples' END,
  CASE WHEN p_size % 4 > 0 THEN concat(chr(10), 'Input', chr(10), CAST(p_size AS STRING), ' 1', chr(10), 'Output', chr(10), CAST(p_size + 1 AS STRING)) ELSE '' END,
  CASE WHEN p_size % 3 > 0 THEN concat(chr(10), 'Input: ', CAST(p_size AS STRING), chr(10), 'Output:', CASE WHEN p_size % 3 = 1 THEN ' 1' ELSE ' ' END) ELSE '' END,
  CASE WHEN p_size % 5 = 0 THEN concat(chr(10), CASE WHEN p_size % 2 = 0 THEN 'Note' ELSE 'Constraints:' END, chr(10), 'see below') ELSE '' END,
  CASE WHEN p_size % 7 > 3 THEN concat(chr(10), 'Sample input', chr(10), '5', chr(10), CAST(p_size AS STRING), chr(10), 'Sample output:', chr(10), '6') ELSE '' END) END AS input
FROM part"""

#: Printed and expected outputs: the same, spaced, rounded or ordered otherwise, or of another number.
OUTPUTS = """
SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN concat(CAST(o_custkey AS STRING), chr(10)) WHEN 1 THEN concat('  ', CAST(o_custkey AS STRING), ' ')
    WHEN 2 THEN concat(CAST(o_custkey AS STRING), '.0000000000001') WHEN 3 THEN CAST(o_custkey + o_custkey % 2 AS STRING) WHEN 4 THEN concat('b ', CAST(o_custkey AS STRING), ' a')
    WHEN 5 THEN '' WHEN 6 THEN concat(CAST(o_custkey AS STRING), chr(10), chr(10), '7') WHEN 7 THEN concat(CAST(o_custkey AS STRING), '.', CAST(o_custkey % 3 AS STRING)) ELSE concat('x', chr(10), o_orderpriority, ' ', CAST(o_custkey AS STRING)) END AS output,
  CASE o_orderkey % 9 WHEN 2 THEN concat(CAST(o_custkey AS STRING), '.0') WHEN 4 THEN concat('a b ', CAST(o_custkey + o_custkey % 2 AS STRING)) WHEN 6 THEN concat(CAST(o_custkey AS STRING), chr(10), '7')
    WHEN 8 THEN concat('x ', chr(10), CAST(o_custkey AS STRING), ' ', o_orderpriority, CASE WHEN o_custkey % 4 = 0 THEN ' y' ELSE '' END) ELSE CAST(o_custkey AS STRING) END AS expected
FROM orders"""

#: Programs that multiply and add, and what they should give, which every fifth does not; tests and how they are given differ.
PROGRAMS = """
SELECT s_suppkey, s_nationkey AS factor, s_suppkey % 7 AS term, s_suppkey % 50 AS given, CAST(s_suppkey % 50 * s_nationkey + s_suppkey % 7 + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS STRING) AS expected,
  CASE s_suppkey % 6 WHEN 0 THEN 'assert' WHEN 1 THEN 'completion' WHEN 2 THEN 'samples' WHEN 3 THEN 'private' WHEN 4 THEN 'examples' ELSE 'none' END AS form
FROM supplier"""

#: Answers with one or two blocks of code, or none.
FENCED = """
SELECT p_partkey, replace(concat('Part ', p_brand, chr(10), CASE p_partkey % 5 WHEN 0 THEN concat('~python', chr(10), 'print(', CAST(p_size AS STRING), ')', chr(10), '~ and ~', chr(10), '3', chr(10), '~')
  WHEN 1 THEN concat('~', chr(10), CAST(p_size AS STRING), chr(10), '~ or ~', chr(10), 'def f(x):', chr(10), '  return ', CAST(p_size AS STRING), chr(10), '~')
  WHEN 2 THEN concat('~py', chr(10), 'x = ', CAST(p_size AS STRING), chr(10), '~ better: ~Python', chr(10), 'y = ', CAST(p_size AS STRING), chr(10), '~') WHEN 3 THEN concat('~', chr(10), p_name, chr(10), '~') ELSE p_name END), '~', '```') AS answer
FROM part"""

#: JSON lines of customers with blank and broken lines between.
LINES = """
SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN '  ' WHEN 1 THEN '{"c_custkey": ' ELSE concat('{"c_custkey": ', CAST(c_custkey AS STRING), ', "c_name": "', c_name, '"}') END AS value
FROM customer"""

#: Rows to look tests up for, and the datasets with them.
HYDRATE = """
SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'apps' WHEN 1 THEN 'TACO' WHEN 2 THEN 'own' END AS dataset, CASE p_partkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' END AS split,
  CASE WHEN p_partkey % 10 = 0 THEN 'x' ELSE concat(' ', CAST(p_size AS STRING), ' ') END AS index, p_name AS input, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS input_output
FROM part"""
LOOKUP = """
SELECT CASE s_suppkey % 2 WHEN 0 THEN 'apps' ELSE 'taco' END AS dataset, CASE WHEN s_suppkey % 4 < 2 THEN 'train' ELSE 'test' END AS split, s_suppkey AS index,
  CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE s_name END AS question, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat('t', CAST(s_suppkey AS STRING)) END AS tests
FROM supplier"""

#: Requests with a latency, two of a kind among them.
REQUESTS = """SELECT event_id AS request_id, CAST(event_id % 1000 AS DOUBLE) AS finished, CAST(user_id % 97 AS DOUBLE) / 8 AS latency, CAST(6758 + user_id % 8 AS INT) AS port, event_id % 9 <> 0 AS ok FROM events"""

SEGMENTS = """SELECT concat('segment_', lpad(CAST(s_suppkey AS STRING), 6, '0'), '.jsonl') AS name, s_suppkey * 379 % 5000 AS bytes FROM supplier"""

#: Turns as messages; every seventh is given reasoning, tool calls or a name.
TURNS = """
SELECT conv_id, turn, role, text AS content, CASE WHEN (conv_id + turn) % 7 = 0 THEN concat('because ', CAST(turn AS STRING)) WHEN (conv_id + turn) % 7 = 1 THEN '  ' END AS reasoning_content,
  CASE WHEN (conv_id + turn) % 7 = 2 THEN '[{"n": 1}]' END AS tool_calls, CASE WHEN (conv_id + turn) % 7 = 3 THEN 'id7' END AS tool_call_id, CASE WHEN (conv_id + turn) % 7 = 4 THEN 'bob' END AS name
FROM conversations"""


def load(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of one of the texts above, its tables bound to the folder's files and no global name touched."""
    import re

    used = [t for t in TABLES if re.search(rf"\bFROM {t}\b", sql)]
    return spark.sql(re.sub(rf"\bFROM ({'|'.join(TABLES)})\b", r"FROM {\1}", sql.replace("{", "{{").replace("}", "}}")) if used else sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, messages): turns in order."""
    turns = load(spark, sf_dir, TURNS)
    keys = ("role", "content", "reasoning_content", "tool_calls", "tool_call_id", "name")
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", *keys))).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda m: F.struct(*[m[k].alias(k) for k in keys])).alias("messages"))


def with_messages(df: DataFrame, column: str = "answer") -> DataFrame:
    """A user's and an assistant's message around a column."""
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))
    return df.withColumn("messages", F.array(said("user", F.lit("q")), said("assistant", F.col(column)))).drop(column)

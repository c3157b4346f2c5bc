"""Shapes of the engine's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}
MESSAGE_KEYS = ("role", "content", "reasoning_content", "tool_calls", "tool_call_id", "name")
#: Messages; tool calls are JSON text.
MESSAGES = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in MESSAGE_KEYS]))
KEY = ["source_file", "source_row", "rollout_index"]


def struct(columns: str) -> T.StructType:
    """A struct of "name kind" pairs; it needs no session, unlike a DDL text."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(n, MESSAGES if k == "messages" else _KINDS[k]) for n, k in pairs])


#: The record, in the order of its columns. JSON of free shape (generation_usage, judge_detail) is text.
RECORD = struct(
    """dataset_name string, sample_id string, dedup_hash string, content_chars bigint, turn_count bigint, has_reasoning boolean,
    text string, messages messages, chosen string, rejected string, tools string, system string, metadata string,
    adapter_status string, adapter_error string, adapter_name string, record_mode string, generation_finish_reason string,
    generation_usage string, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint, source_file string,
    source_row bigint, rollout_index bigint, judge_type string, judge_backend string, is_correct boolean, judge_status string,
    judge_detail string"""
)
FAILURE = struct("source_file string, source_row bigint, rollout_index bigint, reason string, time double")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the schema's columns: missing ones null, others cast, structs and maps as JSON where text is asked for."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        kind = have.get(f.name)
        if kind is None:
            column = F.lit(None)
        elif isinstance(f.dataType, T.StringType) and isinstance(kind, T.StructType | T.MapType | T.ArrayType):
            column = F.to_json(f"`{f.name}`", {"ignoreNullFields": "false"})
        else:
            column = F.col(f"`{f.name}`")
        out.append(column.cast(f.dataType).alias(f.name))
    return df.select(*out)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """One frame of files whose inferred schemas drifted apart: columns by name, missing ones null."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first
